"""One small document per flattening and normalising rule."""

import pytest
from pyspark.sql import functions as F

from tendril import schema as S
from tendril.operators import flatten as fl
from tendril.operators import normalize as nz
from tendril.operators import quality as ql

HEAD = '<CODIF_DATA><TD_DOCUMENT_TYPE CODE="7">{kind}</TD_DOCUMENT_TYPE></CODIF_DATA><NOTICE_DATA><NO_DOC_OJS>2019/S 001-000001</NO_DOC_OJS><URI_LIST><URI_DOC LG="EN">u</URI_DOC></URI_LIST>{extra}</NOTICE_DATA>'


def doc(forms, extra='<ORIGINAL_CPV CODE="03111400">Seeds</ORIGINAL_CPV>', kind="Contract notice"):
    return f'<EXPORT xmlns:n2016="u"><CODED_DATA_SECTION>{HEAD.format(kind=kind, extra=extra)}</CODED_DATA_SECTION><FORM_SECTION>{forms}</FORM_SECTION></EXPORT>'


def form(body="", lg="EN"):
    return f'<F02_2014 LG="{lg}" CATEGORY="ORIGINAL" FORM="F02">{body}</F02_2014>'


CASES = {
    "single_other_language": doc(form(lg="PL")),
    "two_forms": doc(form("<T>fr</T>", "FR") + form("<T>en</T>")),
    "without_language": doc(form(lg="FR") + form(lg="DE")),
    "several_cpv": doc(form(), '<ORIGINAL_CPV CODE="03111400">Seeds</ORIGINAL_CPV><ORIGINAL_CPV CODE="45000000">Works</ORIGINAL_CPV>'),
    "repeated": doc(form("<A><B>1</B><B>2</B></A><A><B>3</B></A>")),
    "paragraphs": doc(form("<A><P>one</P></A><B><P>one</P><P>two <FT TYPE='SUP'>x</FT>more</P></B><C><P><D>inner</D></P></C>")),
    "empty": doc(form("<A/><B> </B>")),
    "old_single": doc(form('<VALUES_LIST><VALUES><SINGLE_VALUE><VALUE CURRENCY="SEK">20</VALUE></SINGLE_VALUE></VALUES></VALUES_LIST>')),
    "old_range": doc(form('<VALUES_LIST><VALUES><RANGE_VALUE><VALUE CURRENCY="EUR">5</VALUE><VALUE CURRENCY="EUR">9</VALUE></RANGE_VALUE></VALUES></VALUES_LIST>')),
    "unknown_currency": doc(form(), '<VALUES><VALUE CURRENCY="XXX">7</VALUE></VALUES>'),
    "bad_number": doc(form(), '<VALUES><VALUE CURRENCY="SEK">n/a</VALUE></VALUES>'),
    "euro": doc(form(), '<VALUES><VALUE CURRENCY="EUR">007.50</VALUE></VALUES>'),
    "reference": doc(form(), "<REF_NOTICE><NO_DOC_OJS>2018/S 9</NO_DOC_OJS></REF_NOTICE>"),
    "attribute_and_child": doc(form('<A B="attr"><B>child</B></A>')),
    "other_type": doc(form(), kind="Something else"),
    "escaped_type": doc(form(), kind="Contract &amp; notice"),
    "broken": doc(form())[:-9],
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(name, "20190102", text) for name, text in CASES.items()], "file string, date string, value string")


@pytest.fixture(scope="module")
def flat(docs):
    return {r["file"]: r for r in fl.notice_rows(docs).collect()}


@pytest.fixture(scope="module")
def table(spark, docs):
    rates = spark.createDataFrame([("SEK", 10.0)], "currency string, rate double")
    return nz.extracted(fl.notice_columns(docs, S.source_paths()), rates).persist()


def test_language_choice(flat):
    assert flat["single_other_language"]["form"]["LG"] == ["PL"]
    assert flat["two_forms"]["form"]["T"] == ["en"]
    assert "without_language" not in flat


def test_strict_and_open_language(docs):
    strict = {r["file"] for r in fl.notice_rows(docs, strict=True).collect()}
    assert "single_other_language" not in strict and "two_forms" in strict
    assert fl.notice_rows(docs, None).filter("file in ('two_forms', 'without_language')").count() == 4


def test_type_filter_and_broken_documents(docs, flat):
    assert not {"other_type", "escaped_type", "broken"} & set(flat)
    assert "escaped_type" in {r["file"] for r in fl.notice_rows(docs, types=["Contract & notice"]).collect()}
    assert [r["file"] for r in fl.broken_documents(docs).collect()] == ["broken"]


def test_flatten_rules(flat):
    form = lambda name: flat[name]["form"]
    assert form("repeated")["A__B"] == ["1", "2", "3"]
    assert form("paragraphs")["A"] == ["one"]
    assert form("paragraphs")["B"] == ["one", "two more"]
    assert form("paragraphs")["C__P__D"] == ["inner"]
    assert set(form("empty")) == {"LG", "CATEGORY", "FORM"}
    assert form("attribute_and_child")["A__B"] == ["attr", "child"]
    assert flat["several_cpv"]["header"]["ORIGINAL_CPV__CODE"] == ["03111400", "45000000"]
    assert not any(path.startswith("URI") for path in flat["repeated"]["header"])


def test_declared_flatten_agrees(docs):
    paths = ["A", "A__B", "B", "C__P__D", "T", "LG"]
    parsed, kind = fl.flatten_declared(F.col("value"), {"CODIF_DATA": [], "NOTICE_DATA": ["ORIGINAL_CPV__CODE"], "FORM": paths}, ["F02_2014"])
    node = kind["FORM_SECTION"].dataType["F02_2014"].dataType.elementType
    good = docs.filter("file <> 'broken'")
    rows = good.select("file", parsed.alias("d")).select("file", F.explode("d.FORM_SECTION.F02_2014").alias("form"))
    native = rows.select("file", *[fl.declared_values(F.array("form"), node, p).alias(p) for p in paths])
    helper = fl.notice_rows(good, None, types=[]).select("file", *[F.try_element_at("form", F.lit(p)).alias(p) for p in paths])
    key = lambda r: [str(v) for v in r]
    assert sorted(map(tuple, native.collect()), key=key) == sorted(map(tuple, helper.collect()), key=key)


def test_extracted_table(table):
    rows = {r["FILE"]: r for r in table.collect()}
    assert table.columns == [f.name for f in S.extracted_type()] and len(table.columns) == 127
    assert [f.dataType for f in table.schema] == [f.dataType for f in S.extracted_type()]
    assert (rows["old_single"]["VALUES__VALUE"], rows["old_single"]["VALUE_EUR"]) == ("20", "2.0")
    assert (rows["old_range"]["VALUES__VALUE"], rows["old_range"]["VALUES__VALUE__CURRENCY"], rows["old_range"]["VALUE_EUR"]) == ("5", "EUR", "5")
    assert rows["unknown_currency"]["VALUE_EUR"] == rows["bad_number"]["VALUE_EUR"] == rows["empty"]["VALUE_EUR"] == ""
    assert rows["euro"]["VALUE_EUR"] == "007.50"
    assert rows["reference"]["REF_NO"] == "2018/S 9" and rows["euro"]["REF_NO"] == ""
    assert rows["several_cpv"]["ORIGINAL_CPV_TEXT"] == ["Seeds", "Works"] and rows["several_cpv"]["MAIN_CPV_CODE"] == "03111400"
    assert rows["euro"]["ORIGINAL_CPV_CODE"] is None
    assert (rows["euro"]["DATE"], rows["euro"]["YEAR"]) == ("20190102", "2019")


def test_fixed_lists():
    assert len(S.COLUMNS) == 121 and len(S.LIST_COLUMNS) == 39 and len(S.merged_mapping()) == 129


def test_merged_table(table):
    merged = nz.merged(table)
    kinds = dict(merged.dtypes)
    assert kinds["value_eur"] == "float" and kinds["procedure__date_receipt_tenders"] == "date" and kinds["n2016_performance_nuts"] == "array<string>"
    values = {r["file"]: r["value_eur"] for r in merged.collect()}
    assert values["euro"] == 7.5 and values["bad_number"] is None


def test_fixed_projection_adds_and_orders_columns(spark):
    out = nz.fixed_projection(spark.createDataFrame([("x", 1)], "VERSION string, other int"), S.extracted_type())
    assert out.columns[-7:][0] == "VERSION" and out.first()["VERSION"] == "x" and out.first()["DATE"] is None


@pytest.mark.parametrize("rule, good, bad", [
    ("date", "20191231", "20191331"), ("datetime", "20190101 23:59", "20190101 24:00"), ("document_number", "123456-2019", "1234567-2019"),
    ("notice_number", "2019/S 001-000001", "2019/S 1-1"), ("amount", "12.50", "12.505"), ("time", "9:59", "25:00"), ("phone", "+49 12345678/79", "12345678"),
    ("e_mail", "a@b.c", "a.b"), ("url", "https://x.y/z?q=1", "ht://x"), ("full_date", "2019-01-01", "2119-01-01")])
def test_patterns(spark, rule, good, bad):
    row = spark.createDataFrame([(good, bad)], "g string, b string").select(ql.matches(F.col("g"), rule), ql.matches(F.col("b"), rule)).first()
    assert tuple(row) == (True, False)


def test_named_columns_of_the_notice_table(spark):
    """The stream's table limited to some columns reads their paths alone, older places of the value among them."""
    from tendril.streaming import ingest as ig

    head = "<NOTICE_EXPORT><CODED_DATA_SECTION><NOTICE_DATA><LG_ORIG>EN</LG_ORIG>{}</NOTICE_DATA><CODIF_DATA><TD_DOCUMENT_TYPE CODE=\"7\">Contract award notice</TD_DOCUMENT_TYPE></CODIF_DATA></CODED_DATA_SECTION>"
    form = "<FORM_SECTION><F03_2014 LG=\"EN\" CATEGORY=\"ORIGINAL\" FORM=\"F03\">{}</F03_2014></FORM_SECTION></NOTICE_EXPORT>"
    value = "<VALUES><VALUE CURRENCY=\"EUR\">5</VALUE></VALUES>"
    older = "<VALUES_LIST><VALUES><SINGLE_VALUE><VALUE CURRENCY=\"EUR\">7</VALUE></SINGLE_VALUE></VALUES></VALUES_LIST>"
    texts = [head.format(value) + form.format(""), head.format("") + form.format(older), head.format("") + form.format("")]
    docs = spark.createDataFrame([(f"{i}.xml", "20200101", x) for i, x in enumerate(texts)], "file string, date string, value string")
    rates = spark.createDataFrame([("SEK", 10.5)], "currency string, rate double")
    names = ["FILE", "LG", "VALUES__VALUE"]
    got = ig.notice_table(docs, rates, names)
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, ig.notice_table(docs, rates).select(*names).collect()), key=str)
    assert {r["VALUES__VALUE"] for r in got.collect()} >= {"5", "7"}


def test_rows_are_not_dealt_by_currency(spark):
    """A rate table of unknown size: amounts stay where they are, however few currencies there are."""
    from tendril.operators import normalize as nz

    rates = spark.createDataFrame(spark.sparkContext.parallelize([("SEK", 10.0), ("GBP", 0.5)]), "currency string, rate double")
    amounts = spark.createDataFrame([("5", "SEK"), ("5", "GBP"), ("5", "EUR"), ("5", "ZZZ"), ("5", None), ("x", "SEK")], "v string, c string")
    out = nz.to_eur(amounts, rates, "v", "c", "e")
    assert [r["e"] for r in out.collect()] == ["0.5", "10.0", "5", "", "", ""]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
