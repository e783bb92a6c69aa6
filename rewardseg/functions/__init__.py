"""Column expressions: predicates, label ladders, spend bands, recodes."""

from rewardseg.functions.classify import (all_bands, category_band, category_index,
                                          descending_label, gender_code, season_label,
                                          segment_label, size_label, spend_band, volume_label)
from rewardseg.functions.predicates import (any_flag, in_range, matched, month_of, ne_or_null,
                                            valid_on)

__all__ = ["all_bands", "category_band", "category_index", "descending_label", "gender_code",
           "season_label", "segment_label", "size_label", "spend_band", "volume_label",
           "any_flag", "in_range", "matched", "month_of", "ne_or_null", "valid_on"]
