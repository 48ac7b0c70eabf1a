"""Columns of the extracted notice table and of the merged table."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the extracted table, in order.
COLUMNS = [
    "AA_AUTHORITY_TYPE",
    "AA_AUTHORITY_TYPE__CODE",
    "AC_AWARD_CRIT",
    "AC_AWARD_CRIT__CODE",
    "CATEGORY",
    "DATE",
    "YEAR",
    "DS_DATE_DISPATCH",
    "FILE",
    "HEADING",
    "ISO_COUNTRY__VALUE",
    "LG",
    "LG_ORIG",
    "NC_CONTRACT_NATURE",
    "NC_CONTRACT_NATURE__CODE",
    "NO_DOC_OJS",
    "ORIGINAL_CPV_CODE",
    "ORIGINAL_CPV_TEXT",
    "PR_PROC",
    "PR_PROC__CODE",
    "REF_NO",
    "RP_REGULATION",
    "RP_REGULATION__CODE",
    "TD_DOCUMENT_TYPE",
    "TD_DOCUMENT_TYPE__CODE",
    "TY_TYPE_BID",
    "TY_TYPE_BID__CODE",
    "COMPLEMENTARY_INFO__ADDRESS_REVIEW_BODY__ADDRESS",
    "COMPLEMENTARY_INFO__ADDRESS_REVIEW_BODY__COUNTRY__VALUE",
    "COMPLEMENTARY_INFO__ADDRESS_REVIEW_BODY__OFFICIALNAME",
    "COMPLEMENTARY_INFO__ADDRESS_REVIEW_BODY__POSTAL_CODE",
    "COMPLEMENTARY_INFO__ADDRESS_REVIEW_BODY__TOWN",
    "COMPLEMENTARY_INFO__DATE_DISPATCH_NOTICE",
    "CONTRACTING_BODY__ADDRESS_CONTRACTING_BODY__ADDRESS",
    "CONTRACTING_BODY__ADDRESS_CONTRACTING_BODY__COUNTRY__VALUE",
    "CONTRACTING_BODY__ADDRESS_CONTRACTING_BODY__E_MAIL",
    "CONTRACTING_BODY__ADDRESS_CONTRACTING_BODY__OFFICIALNAME",
    "CONTRACTING_BODY__ADDRESS_CONTRACTING_BODY__POSTAL_CODE",
    "CONTRACTING_BODY__ADDRESS_CONTRACTING_BODY__TOWN",
    "CONTRACTING_BODY__ADDRESS_CONTRACTING_BODY__URL_GENERAL",
    "CONTRACTING_BODY__ADDRESS_CONTRACTING_BODY__n2016:NUTS__CODE",
    "FORM",
    "IA_URL_GENERAL",
    "INITIATOR",
    "MA_MAIN_ACTIVITIES",
    "MA_MAIN_ACTIVITIES__CODE",
    "OBJECT_CONTRACT__CPV_MAIN__CPV_CODE__CODE",
    "OBJECT_CONTRACT__OBJECT_DESCR__CPV_ADDITIONAL__CPV_CODE__CODE",
    "OBJECT_CONTRACT__OBJECT_DESCR__ITEM",
    "OBJECT_CONTRACT__OBJECT_DESCR__SHORT_DESCR",
    "OBJECT_CONTRACT__OBJECT_DESCR__n2016:NUTS__CODE",
    "OBJECT_CONTRACT__SHORT_DESCR",
    "OBJECT_CONTRACT__TITLE",
    "OBJECT_CONTRACT__TYPE_CONTRACT__CTYPE",
    "n2016:CA_CE_NUTS",
    "n2016:CA_CE_NUTS__CODE",
    "n2016:PERFORMANCE_NUTS",
    "n2016:PERFORMANCE_NUTS__CODE",
    "COMPLEMENTARY_INFO__ADDRESS_REVIEW_BODY__PHONE",
    "CONTRACTING_BODY__ADDRESS_CONTRACTING_BODY__PHONE",
    "CONTRACTING_BODY__ADDRESS_CONTRACTING_BODY__URL_BUYER",
    "CONTRACTING_BODY__CA_ACTIVITY__VALUE",
    "CONTRACTING_BODY__CA_TYPE__VALUE",
    "LEGAL_BASIS__VALUE",
    "OBJECT_CONTRACT__REFERENCE_NUMBER",
    "REF_NOTICE__NO_DOC_OJS",
    "VALUES__VALUE",
    "VALUES__VALUE__CURRENCY",
    "VALUES__VALUE__TYPE",
    "VALUE_EUR",
    "AWARD_CONTRACT__ITEM",
    "AWARD_CONTRACT__AWARDED_CONTRACT__DATE_CONCLUSION_CONTRACT",
    "AWARD_CONTRACT__TITLE",
    "OBJECT_CONTRACT__VAL_TOTAL",
    "OBJECT_CONTRACT__VAL_TOTAL__CURRENCY",
    "PROCEDURE__NOTICE_NUMBER_OJ",
    "n2016:TENDERER_NUTS",
    "n2016:TENDERER_NUTS__CODE",
    "CONTRACTING_BODY__URL_DOCUMENT",
    "CONTRACTING_BODY__URL_PARTICIPATION",
    "DT_DATE_FOR_SUBMISSION",
    "IA_URL_ETENDERING",
    "OBJECT_CONTRACT__OBJECT_DESCR__DURATION",
    "OBJECT_CONTRACT__OBJECT_DESCR__DURATION__TYPE",
    "PROCEDURE__DATE_RECEIPT_TENDERS",
    "PROCEDURE__LANGUAGES__LANGUAGE__VALUE",
    "PROCEDURE__OPENING_CONDITION__DATE_OPENING_TENDERS",
    "PROCEDURE__OPENING_CONDITION__TIME_OPENING_TENDERS",
    "PROCEDURE__TIME_RECEIPT_TENDERS",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__COUNTRY__VALUE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__OFFICIALNAME",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__POSTAL_CODE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__TOWN",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__n2016:NUTS__CODE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__TENDERS__NB_TENDERS_RECEIVED",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VALUES__VAL_TOTAL",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VALUES__VAL_TOTAL__CURRENCY",
    "AWARD_CONTRACT__CONTRACT_NO",
    "AWARD_CONTRACT__LOT_NO",
    "COMPLEMENTARY_INFO__ADDRESS_REVIEW_BODY__E_MAIL",
    "COMPLEMENTARY_INFO__ADDRESS_REVIEW_BODY__FAX",
    "COMPLEMENTARY_INFO__ADDRESS_REVIEW_INFO__COUNTRY__VALUE",
    "COMPLEMENTARY_INFO__ADDRESS_REVIEW_INFO__OFFICIALNAME",
    "COMPLEMENTARY_INFO__ADDRESS_REVIEW_INFO__TOWN",
    "COMPLEMENTARY_INFO__INFO_ADD",
    "LEFTI__SUITABILITY",
    "PROCEDURE__DURATION_TENDER_VALID",
    "PROCEDURE__DURATION_TENDER_VALID__TYPE",
    "FD_OTH_NOT__OBJ_NOT__BLK_BTX",
    "FD_OTH_NOT__OBJ_NOT__CPV__CPV_MAIN__CPV_CODE__CODE",
    "FD_OTH_NOT__OBJ_NOT__INT_OBJ_NOT",
    "FD_OTH_NOT__STI_DOC__P__ADDRESS_NOT_STRUCT__ADDRESS",
    "FD_OTH_NOT__STI_DOC__P__ADDRESS_NOT_STRUCT__BLK_BTX",
    "FD_OTH_NOT__STI_DOC__P__ADDRESS_NOT_STRUCT__COUNTRY__VALUE",
    "FD_OTH_NOT__STI_DOC__P__ADDRESS_NOT_STRUCT__E_MAIL",
    "FD_OTH_NOT__STI_DOC__P__ADDRESS_NOT_STRUCT__ORGANISATION",
    "FD_OTH_NOT__STI_DOC__P__ADDRESS_NOT_STRUCT__PHONE",
    "FD_OTH_NOT__STI_DOC__P__ADDRESS_NOT_STRUCT__POSTAL_CODE",
    "FD_OTH_NOT__STI_DOC__P__ADDRESS_NOT_STRUCT__TOWN",
    "FD_OTH_NOT__TI_DOC",
    "VERSION",
]

# The columns that hold lists; all others hold one string.
LIST_COLUMNS = [
    "ORIGINAL_CPV",
    "ORIGINAL_CPV_CODE",
    "ORIGINAL_CPV_TEXT",
    "ORIGINAL_CPV__CODE",
    "OBJECT_CONTRACT__SHORT_DESCR",
    "PROCEDURE__LANGUAGES__LANGUAGE__VALUE",
    "OBJECT_CONTRACT__OBJECT_DESCR__CPV_ADDITIONAL__CPV_CODE__CODE",
    "OBJECT_CONTRACT__OBJECT_DESCR__ITEM",
    "OBJECT_CONTRACT__OBJECT_DESCR__SHORT_DESCR",
    "OBJECT_CONTRACT__OBJECT_DESCR__n2016:NUTS__CODE",
    "OBJECT_CONTRACT__OBJECT_DESCR__DURATION",
    "OBJECT_CONTRACT__OBJECT_DESCR__DURATION__TYPE",
    "COMPLEMENTARY_INFO__INFO_ADD",
    "LEFTI__SUITABILITY",
    "AWARD_CONTRACT__ITEM",
    "AWARD_CONTRACT__AWARDED_CONTRACT__DATE_CONCLUSION_CONTRACT",
    "AWARD_CONTRACT__TITLE",
    "n2016:TENDERER_NUTS",
    "n2016:TENDERER_NUTS__CODE",
    "AWARD_CONTRACT__CONTRACT_NO",
    "n2016:PERFORMANCE_NUTS",
    "n2016:PERFORMANCE_NUTS__CODE",
    "n2016:CA_CE_NUTS",
    "n2016:CA_CE_NUTS__CODE",
    "AWARD_CONTRACT__LOT_NO",
    "LG_ORIG",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__COUNTRY__VALUE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__OFFICIALNAME",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__POSTAL_CODE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__TOWN",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__n2016:NUTS__CODE",
    "FD_OTH_NOT__STI_DOC__P__ADDRESS_NOT_STRUCT__BLK_BTX",
    "FD_OTH_NOT__OBJ_NOT__BLK_BTX",
    "MA_MAIN_ACTIVITIES",
    "MA_MAIN_ACTIVITIES__CODE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__TENDERS__NB_TENDERS_RECEIVED",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VALUES__VAL_TOTAL",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VALUES__VAL_TOTAL__CURRENCY",
    "FD_OTH_NOT__TI_DOC",
]

# List columns whose first element gets a MAIN_ column.
FIRST_OF = [
    "ORIGINAL_CPV_CODE",
    "n2016:TENDERER_NUTS__CODE",
    "n2016:PERFORMANCE_NUTS__CODE",
    "MA_MAIN_ACTIVITIES__CODE",
    "OBJECT_CONTRACT__OBJECT_DESCR__DURATION",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__COUNTRY__VALUE",
]
FIRST_NAMES = {c: ("MAIN_CPV_CODE" if c == "ORIGINAL_CPV_CODE" else f"MAIN_{c}") for c in FIRST_OF}

# Document types kept by default.
DOCUMENT_TYPES = ["Contract award notice", "Contract notice", "Contract award", "Additional information"]

# Merged-table columns that are not plain copies.
MERGED_TYPES = {
    "values__value": "float",
    "value_eur": "float",
    "object_contract__val_total": "float",
    "procedure__date_receipt_tenders": "date",
    "procedure__opening_condition__date_opening_tenders": "date",
    "procedure__duration_tender_valid": "int",
}

# Columns computed from others rather than found at their own path.
DERIVED = ["DATE", "YEAR", "FILE", "ORIGINAL_CPV_CODE", "ORIGINAL_CPV_TEXT", "REF_NO", "VALUE_EUR"]

# Older places of the notice value, single and range.
OLD_SINGLE_VALUE = "VALUES_LIST__VALUES__SINGLE_VALUE__VALUE"
OLD_RANGE_VALUE = "VALUES_LIST__VALUES__RANGE_VALUE__VALUE"


def is_list(column: str) -> bool:
    return column in LIST_COLUMNS


def source_paths(columns: list[str] | None = None) -> list[str]:
    """Every path the fixed projection reads, or those that the named ``columns`` of it need."""
    value, currency = [OLD_SINGLE_VALUE, OLD_RANGE_VALUE], [OLD_SINGLE_VALUE + "__CURRENCY", OLD_RANGE_VALUE + "__CURRENCY"]
    if columns is None:
        return [c for c in COLUMNS if c not in DERIVED] + ["ORIGINAL_CPV", "ORIGINAL_CPV__CODE", *value, *currency]
    value, currency = ["VALUES__VALUE", *value], ["VALUES__VALUE", "VALUES__VALUE__CURRENCY", *currency]
    made = {"ORIGINAL_CPV_CODE": ["ORIGINAL_CPV__CODE"], "ORIGINAL_CPV_TEXT": ["ORIGINAL_CPV"], "REF_NO": ["REF_NOTICE__NO_DOC_OJS"], "VALUES__VALUE": value, "VALUES__VALUE__CURRENCY": currency,
            "VALUE_EUR": value + currency}
    whole = {n: c for c, n in FIRST_NAMES.items()}
    named = [whole.get(c, c) for c in columns]
    return list(dict.fromkeys(p for c in named for p in made.get(c, [] if c in DERIVED else [c])))


def extracted_type() -> T.StructType:
    """Schema of the extracted table: the fixed columns, then the MAIN_ ones."""
    fields = [T.StructField(c, T.ArrayType(T.StringType()) if is_list(c) else T.StringType()) for c in COLUMNS]
    return T.StructType(fields + [T.StructField(n, T.StringType()) for n in FIRST_NAMES.values()])


def merged_name(column: str) -> str:
    return column.lower().replace(":", "_")


def merged_mapping() -> list[tuple[str, str, str]]:
    """(source column, target column, target type) of the merged table: lower-cased, safe names, typed values."""
    kinds = {c: "array<string>" if is_list(c) else "string" for c in [*COLUMNS, *LIST_COLUMNS]}
    kinds |= {n: "string" for n in FIRST_NAMES.values()}
    return [(c, merged_name(c), MERGED_TYPES.get(merged_name(c), k)) for c, k in kinds.items()]


# Columns of the award comparison.
AWARD_COLUMNS = [
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__ADDRESS",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__COUNTRY__VALUE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__E_MAIL",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__FAX",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__NATIONALID",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__OFFICIALNAME",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__PHONE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__POSTAL_CODE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__TOWN",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__URL",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__CONTRACTOR__ADDRESS_CONTRACTOR__n2016:NUTS__CODE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTORS__PUBLICATION",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTOR__ADDRESS_CONTRACTOR__ADDRESS",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTOR__ADDRESS_CONTRACTOR__COUNTRY__VALUE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTOR__ADDRESS_CONTRACTOR__E_MAIL",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTOR__ADDRESS_CONTRACTOR__FAX",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTOR__ADDRESS_CONTRACTOR__NATIONALID",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTOR__ADDRESS_CONTRACTOR__OFFICIALNAME",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTOR__ADDRESS_CONTRACTOR__PHONE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTOR__ADDRESS_CONTRACTOR__POSTAL_CODE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTOR__ADDRESS_CONTRACTOR__TOWN",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTOR__ADDRESS_CONTRACTOR__URL",
    "AWARD_CONTRACT__AWARDED_CONTRACT__CONTRACTOR__ADDRESS_CONTRACTOR__n2016:NUTS__CODE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__DATE_CONCLUSION_CONTRACT",
    "AWARD_CONTRACT__AWARDED_CONTRACT__INFO_ADD_SUBCONTRACTING",
    "AWARD_CONTRACT__AWARDED_CONTRACT__NB_TENDERS_RECEIVED",
    "AWARD_CONTRACT__AWARDED_CONTRACT__NB_TENDERS_RECEIVED_EMEANS",
    "AWARD_CONTRACT__AWARDED_CONTRACT__NB_TENDERS_RECEIVED_NON_EU",
    "AWARD_CONTRACT__AWARDED_CONTRACT__NB_TENDERS_RECEIVED_OTHER_EU",
    "AWARD_CONTRACT__AWARDED_CONTRACT__NB_TENDERS_RECEIVED_SME",
    "AWARD_CONTRACT__AWARDED_CONTRACT__PCT_SUBCONTRACTING",
    "AWARD_CONTRACT__AWARDED_CONTRACT__TENDERS__NB_TENDERS_RECEIVED",
    "AWARD_CONTRACT__AWARDED_CONTRACT__TENDERS__NB_TENDERS_RECEIVED_EMEANS",
    "AWARD_CONTRACT__AWARDED_CONTRACT__TENDERS__NB_TENDERS_RECEIVED_NON_EU",
    "AWARD_CONTRACT__AWARDED_CONTRACT__TENDERS__NB_TENDERS_RECEIVED_OTHER_EU",
    "AWARD_CONTRACT__AWARDED_CONTRACT__TENDERS__NB_TENDERS_RECEIVED_SME",
    "AWARD_CONTRACT__AWARDED_CONTRACT__TENDERS__PUBLICATION",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VALUE__PUBLICATION",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VALUE__VAL_ESTIMATED_TOTAL",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VALUE__VAL_ESTIMATED_TOTAL__CURRENCY",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VALUE__VAL_RANGE_TOTAL__CURRENCY",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VALUE__VAL_RANGE_TOTAL__HIGH",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VALUE__VAL_RANGE_TOTAL__LOW",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VALUE__VAL_TOTAL",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VALUE__VAL_TOTAL__CURRENCY",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VAL_BARGAIN_PURCHASE",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VAL_BARGAIN_PURCHASE__CURRENCY",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VAL_ESTIMATED_TOTAL",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VAL_ESTIMATED_TOTAL__CURRENCY",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VAL_RANGE_TOTAL__CURRENCY",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VAL_RANGE_TOTAL__HIGH",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VAL_RANGE_TOTAL__LOW",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VAL_SUBCONTRACTING",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VAL_SUBCONTRACTING__CURRENCY",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VAL_TOTAL",
    "AWARD_CONTRACT__AWARDED_CONTRACT__VAL_TOTAL__CURRENCY",
    "AWARD_CONTRACT__CONTRACT_NO",
    "AWARD_CONTRACT__ITEM",
    "AWARD_CONTRACT__LOT_NO",
    "AWARD_CONTRACT__TITLE",
]
