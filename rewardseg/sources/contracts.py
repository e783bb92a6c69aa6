"""Column contracts of the 20 logical sources.

No DDL exists for the warehouse tables, so the types are the ones the
segmentation relies on: long keys, int flags, exact money, dates for every
date the rules compare (timestamps are truncated in the source contract so
that inclusive date ranges keep the whole end day).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

L, I, S, D = T.LongType(), T.IntegerType(), T.StringType(), T.DateType()
TS = T.TimestampNTZType()
MONEY = T.DecimalType(12, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CONTRACTS: dict[str, T.StructType] = {
    # calendar
    "date_dim": _schema(("date_key", D), ("fin_period_no", I), ("week_no", I),
                        ("relative_week", I)),
    # redemption facts, account grain
    "burn_fact": _schema(("account_number", L), ("tran_points", L), ("tran_date", D),
                         ("supplier_id", S), ("redemption_status", S), ("reason_code", S)),
    "data_profile": _schema(("account_number", L), ("age_band", S), ("gender", S),
                            ("region", S), ("acorn_category", S), ("total_points", L)),
    # product dimension
    "product": _schema(("pi_product_pk", L), ("is_live", I), ("short_desc", S),
                       ("pi_range_subsection_fk", I), ("pi_website_category_l4_fk", L)),
    "range_subsection": _schema(("pi_range_subsection_pk", I), ("pi_range_series_fk", I)),
    "web_category_l4": _schema(
        ("pi_website_category_l4_pk", L), ("pi_website_category_l4_desc", S),
        ("pi_website_category_l3_fk", L), ("pi_website_category_l3_desc", S),
        ("pi_website_category_l2_fk", L), ("pi_website_category_l2_desc", S),
        ("pi_website_category_l1_fk", L), ("pi_website_category_l1_desc", S),
        ("pi_buying_category_fk", L), ("pi_buying_category_desc", S),
        ("website_category_url", S)),
    # retail transactions, entity grain
    "trans_item": _schema(("pi_entity_fk", L), ("pi_trans_fk", L), ("pi_product_fk", L),
                          ("trans_date", D), ("pi_channel_fk", I), ("pi_trans_type_fk", I),
                          ("line_total", MONEY)),
    "channel": _schema(("pi_channel_pk", I)),
    "trans_type": _schema(("pi_trans_type_pk", I), ("pi_trans_type_desc", S)),
    "trans_tender": _schema(("pi_trans_fk", L), ("pi_tender_type_fk", I)),
    "trans": _schema(("pi_trans_pk", L), ("trans_date", D), ("pi_res_fk", L),
                     ("delivery_order_id", L)),
    "reservation": _schema(("pi_res_pk", L), ("res_datetime", TS), ("is_registered_user", I),
                           ("is_prepaid", I), ("pi_cust_identifier_fk", L)),
    "home_delivery": _schema(("delivery_order_pk", L), ("order_datetime", TS),
                             ("is_registered_user", I), ("pi_cust_identifier_fk", L)),
    # identity chain
    "cust_identifier": _schema(("pi_cust_identifier_pk", L), ("pi_entity_fk", L),
                               ("pi_account_id_fk", L)),
    "card_history": _schema(("pi_myaccount_fk", L), ("pi_loyalty_card_fk", L),
                            ("card_link_datetime", D), ("card_unlink_datetime", D)),
    "customer_profiling": _schema(("entitykey", L), ("gender", S)),
    "value_score": _schema(("entitykey", L), ("current_value_score", I), ("run_date", D)),
    "loyalty_card": _schema(("pi_loyalty_card_pk", L), ("loyalty_card_hashed", S)),
    "card_mapping": _schema(("retailer_card_hash", S), ("loyalty_card_hash", S)),
    "full_card": _schema(("account_number", L), ("loyalty_id", S)),
}

SOURCE_NAMES = tuple(CONTRACTS)


class ContractError(ValueError):
    pass


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _loses(have: T.DataType, want: T.DataType) -> bool:
    """Whether a cast could lose something without an error.  Integers that
    do not fit and decimals with too many digits before the point raise in
    ANSI mode; a timestamp becomes its date by contract."""
    if isinstance(want, T.DecimalType):
        if isinstance(have, T.DecimalType):
            return have.scale > want.scale
        return not isinstance(have, _INTEGERS)
    if isinstance(want, _INTEGERS):
        return not (isinstance(have, _INTEGERS) or isinstance(have, T.DecimalType) and have.scale == 0)
    if isinstance(want, T.DateType):
        return not isinstance(have, (T.TimestampType, T.TimestampNTZType))
    if isinstance(want, T.TimestampNTZType):
        return not isinstance(have, (T.TimestampType, T.DateType))
    return isinstance(want, T.StringType) and not isinstance(have, (T.CharType, T.VarcharType, *_INTEGERS))


def conform(df: DataFrame, name: str, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Project ``df`` onto the contract of source ``name``.

    ``columns`` maps contract columns to the source's own names.  Missing
    columns raise; extra columns are pruned (so the scan reads only contract
    columns); types are cast to the contract, which also truncates timestamp
    dates to dates.  A cast that could lose digits raises instead.  Pure
    projection: parquet pushdown and column pruning still reach the scan.
    """
    contract, named = CONTRACTS[name], dict(columns or {})
    unknown = set(named) - {f.name for f in contract.fields}
    if unknown:
        raise ContractError(f"source {name!r} has no contract columns {sorted(unknown)}")
    have = {f.name.lower(): f for f in df.schema.fields}
    source = {f.name: named.get(f.name, f.name).lower() for f in contract.fields}
    missing = [s for s in source.values() if s not in have]
    if missing:
        raise ContractError(f"source {name!r} lacks columns {missing}")
    cols = []
    for field in contract.fields:
        src = have[source[field.name]]
        col = F.col(f"`{src.name}`")
        if src.dataType != field.dataType:
            if _loses(src.dataType, field.dataType):
                raise ContractError(f"source {name!r}: column {src.name!r} is {src.dataType.simpleString()}, "
                                    f"{field.dataType.simpleString()} could lose values; cast it explicitly")
            col = col.cast(field.dataType)
        cols.append(col.alias(field.name))
    return df.select(*cols)
