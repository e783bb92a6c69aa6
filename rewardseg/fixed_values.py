"""Fixed values of the segmentation rules.

Everything below is data that must equal the business rules being reproduced
(labels, thresholds, codes, category names, band cut-offs).  The code that uses
them lives in ``rewardseg.functions`` and ``rewardseg.operators``.
"""

from __future__ import annotations

from decimal import Decimal

# ---------------------------------------------------------------------------
# FIXED VALUES -- must equal the rules being reproduced; do not edit to "fix"
# ---------------------------------------------------------------------------

# Redemption facts kept for the segmentation.
REDEMPTION_STATUS = "RC"
REASON_CODE = "DL"

# Redemption month markers.
NOVEMBER = 11
DECEMBER = 12

# Season label: no November/December redemption vs at least one.
SEASON_NONE = "NO_XMAS_BF"
SEASON_ANY = "XMAS_BF"

# Largest redemption: strictly greater than the threshold, first match wins.
SIZE_LADDER = ((5000, "LARGE_RED"), (2000, "MID_RED"))
SIZE_OTHER = "SMALL_RED"

# Number of redemptions: strictly greater than the threshold, first match wins.
VOLUME_LADDER = ((10, "HIGH"), (4, "MID"), (1, "LOW"))
VOLUME_OTHER = "SINGLE"

# Segment decision labels.
SEGMENT_INFREQUENT = "INFREQUENT"
SEGMENT_LARGE_SEASONAL = "L_X_BF"
SEGMENT_LARGE = "LARGE_RED"
SEGMENT_SEPARATOR = "_"

# Product hierarchy: raco series excluded (NULL series is kept).
EXCLUDED_RANGE_SERIES = 135

# Transaction types counted as retail spend.
TRANS_TYPES = (
    "Walk-in",
    "FastTrack Reservation",
    "Reservation Collection",
    "Home Delivery",
    "FastTrack Home Delivery",
)

# Tender types: loyalty card used in store, loyalty points redeemed in store.
TENDER_LOYALTY_INSTORE = 255
TENDER_REDEMPTION_INSTORE = 37

# Online loyalty: a card linked up to this many days after the order counts.
ONLINE_LINK_GRACE_DAYS = 22

# Gender recode of the retail profile; anything else (NULL included) -> 3.
GENDER_CODES = (("F", 1), ("M", 2))
GENDER_OTHER = 3

# Spend categories: output name -> level-1 category descriptions (exact match).
CATEGORIES = (
    ("baby_nursery", ("Baby and Nursery",)),
    ("appliances", ("Appliances",)),
    ("clothing", ("Clothing",)),
    ("home_garden_diy", ("Home and garden", "Garden and DIY")),
    ("home_furniture", ("Home and furniture",)),
    ("toys", ("Toys",)),
    ("jewellery_watches", ("Jewellery and Watches",)),
    ("sports_leisure", ("Sports and leisure",)),
    ("health_beauty", ("Health and beauty",)),
    ("technology", ("Technology",)),
    ("gifts", ("Gifts",)),
)

# Spend band cut-offs per category, in the order the rules list them.
# Band 1 is spend = 0, band i+2 is (cut[i-1], cut[i]] with cut[-1] = 0, the top
# band is spend > last cut.  Technology lists 174 before 135, so its fifth band
# (174, 135] is empty and spend above 174 falls in band 6 -- kept as written.
BAND_CUTS = {
    "baby_nursery": ("12.5", "23", "37", "68"),
    "appliances": ("30", "60", "120", "240"),
    "clothing": ("10", "100"),
    "home_garden_diy": ("16", "30", "54", "119"),
    "home_furniture": ("20", "40", "79", "184"),
    "toys": ("15", "30", "52", "100"),
    "jewellery_watches": ("10", "20", "30", "60"),
    "sports_leisure": ("15", "25", "50", "135"),
    "health_beauty": ("18", "25", "39", "64"),
    "technology": ("30", "68", "174", "135"),
    "gifts": ("8", "20", "32"),
}

# Guessed repair of the technology ladder (ascending cuts); a separate variant.
TECHNOLOGY_CUTS_FIXED = ("30", "68", "135", "174")

# ---------------------------------------------------------------------------


def cuts(category: str) -> tuple[Decimal, ...]:
    """Band cut-offs of ``category`` as exact decimals."""
    return tuple(Decimal(c) for c in BAND_CUTS[category])


CATEGORY_NAMES = tuple(name for name, _ in CATEGORIES)
SPEND_COLUMNS = tuple(f"{name}_spend" for name in CATEGORY_NAMES)
BAND_COLUMNS = tuple(f"{name}_spend_band" for name in CATEGORY_NAMES)
