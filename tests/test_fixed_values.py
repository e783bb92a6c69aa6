"""The fixed values written out a second time, so that an edit of one shows."""

from rewardseg import fixed_values as fv


def test_codes_and_labels():
    assert (fv.REDEMPTION_STATUS, fv.REASON_CODE, fv.EXCLUDED_RANGE_SERIES) == ("RC", "DL", 135)
    assert (fv.TENDER_LOYALTY_INSTORE, fv.TENDER_REDEMPTION_INSTORE, fv.ONLINE_LINK_GRACE_DAYS) == (255, 37, 22)
    assert fv.SIZE_LADDER == ((5000, "LARGE_RED"), (2000, "MID_RED")) and fv.SIZE_OTHER == "SMALL_RED"
    assert fv.VOLUME_LADDER == ((10, "HIGH"), (4, "MID"), (1, "LOW")) and fv.VOLUME_OTHER == "SINGLE"
    assert (fv.SEASON_NONE, fv.SEASON_ANY) == ("NO_XMAS_BF", "XMAS_BF")
    assert (fv.SEGMENT_INFREQUENT, fv.SEGMENT_LARGE_SEASONAL, fv.SEGMENT_LARGE) == ("INFREQUENT", "L_X_BF", "LARGE_RED")
    assert fv.TRANS_TYPES == ("Walk-in", "FastTrack Reservation", "Reservation Collection", "Home Delivery", "FastTrack Home Delivery")
    assert fv.GENDER_CODES == (("F", 1), ("M", 2)) and fv.GENDER_OTHER == 3
    assert (fv.NOVEMBER, fv.DECEMBER) == (11, 12)


def test_categories_and_cuts():
    assert [(n, " / ".join(g), " ".join(fv.BAND_CUTS[n])) for n, g in fv.CATEGORIES] == [
        ("baby_nursery", "Baby and Nursery", "12.5 23 37 68"),
        ("appliances", "Appliances", "30 60 120 240"),
        ("clothing", "Clothing", "10 100"),
        ("home_garden_diy", "Home and garden / Garden and DIY", "16 30 54 119"),
        ("home_furniture", "Home and furniture", "20 40 79 184"),
        ("toys", "Toys", "15 30 52 100"),
        ("jewellery_watches", "Jewellery and Watches", "10 20 30 60"),
        ("sports_leisure", "Sports and leisure", "15 25 50 135"),
        ("health_beauty", "Health and beauty", "18 25 39 64"),
        ("technology", "Technology", "30 68 174 135"),
        ("gifts", "Gifts", "8 20 32")]
    assert fv.TECHNOLOGY_CUTS_FIXED == ("30", "68", "135", "174")
