import pytest
from pyspark.sql import functions as F

from valuemark.config import Settings, resolve_releases, settings_from, words
from valuemark.functions import scalars as X
from valuemark.functions.matching import token_set_similarity
from valuemark.sources.prices import layout, sniff


def values(spark, rule, *inputs, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", rule(F.col("v")).alias("x")).orderBy("i").collect()]


def test_length_of_stay(spark):
    got = values(spark, lambda c: X.parse_los(c).cast("double"), "3", "120+", "", None, "1,234", "x", " 7 ", "2.5", "120 +")
    assert got == [3.0, 120.0, None, None, 1234.0, None, 7.0, 2.5, 120.0]


def test_dispositions(spark):
    assert values(spark, X.adverse_flag, "Home or Self Care", " home w/ HOME health services", "Skilled Nursing Home", "Expired", "Unknown", "", None) == [0, 0, 1, 1, None, None, None]


def test_group_numbers(spark):
    same = ["470", "0470", "MS-DRG 470", "MSDRG470", "DRG-470", "APR470-1", " 470 "]
    none = ["4700", "1470", "47010", "000", "", None, "MS-DRG 4700"]
    assert values(spark, X.normalize_drg, *same, *none) == ["470"] * 7 + [None] * 7
    assert values(spark, X.normalize_drg, "5", "APR-DRG 005") == ["005", "005"]


@pytest.mark.parametrize(("raw", "declared", "want"), [("APR470-1", "DRG", ("APR-DRG", "470")), ("470", "CPT", None), ("470", "DRG", ("MS-DRG", "470")), ("MS-DRG 470", "APR-DRG", ("MS-DRG", "470")), ("324", "APR-DRG", ("APR-DRG", "324")), ("470", None, None), ("470", "MS DRG", ("MS-DRG", "470"))])
def test_code_systems(spark, raw, declared, want):
    df = spark.createDataFrame([(raw, declared)], "a string, b string")
    got = df.select(X.classify_code(F.col("a"), F.col("b")).alias("x")).first().x
    assert (tuple(got) if got else None) == want


def test_target_codes(spark):
    rows = [("470", "MS-DRG", ""), ("324", "APR-DRG", ""), ("301", "APR-DRG", "HIP JOINT REPLACEMENT"), ("301", "APR-DRG", "OTHER"), ("301", "APR-DRG", None), ("470", "APR-DRG", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, d string")
    got = df.select("i", X.is_target_code(X.classify_code(F.col("a"), F.col("b")), F.col("d"), Settings()).alias("x")).orderBy("i").collect()
    assert [r.x for r in got] == [True, True, True, False, False, False]


def test_numbers(spark):
    assert values(spark, X.clean_currency, "$68,016.00", "n/a", "-", "0", "-5", "1-2", "", None, "5e3") == [68016.0, None, None, None, None, None, None, None, 53.0]
    assert values(spark, X.as_int, "3.9", " 12 ", "NaN", "", None, "x", "inf") == [3, 12, None, None, None, None, None]
    assert values(spark, X.as_number, "$1,200.5", "-3", "0", "x") == [1200.5, -3.0, 0.0, None]
    assert values(spark, X.sentinel_number, "Not Available", "1,234", "2.5", "", None) == [None, None, 2.5, None, None]


def test_names(spark):
    got = values(spark, X.normalize_name, "The Mount Sinai Hospital", "NYP-Columbia & Co.", "St. Mary's Medical Center, Inc.", "SBH Health System", None)
    assert got == ["mount sinai", "newyork presbyterian columbia co", "st marys", "st barnabas", ""]
    assert values(spark, X.significant_tokens, "newyork presbyterian new york of the") == [["newyork", "presbyterian"]]


def test_market_zip_borough_url(spark):
    s = Settings()
    df = spark.createDataFrame([("Kings", None), ("Albany", "New York City"), ("Albany", "x"), ("Albany", None), (None, None)], "c string, a string")
    assert [r.x for r in df.select(X.in_market(F.col("c"), F.col("a"), s).alias("x")).collect()] == [True, True, False, None, None]
    assert values(spark, X.zip3, "100", "OOS", "", "1000") == ["100", None, None, None]
    assert values(spark, X.borough, " new york", "Kings", "Albany") == ["Manhattan", "Brooklyn", "Albany"]
    df = spark.createDataFrame([("/a.json",), ("b.csv",), ("https://z/q",)], "u string")
    assert [r.x for r in df.select(X.resolved_url(F.col("u"), F.lit("https://h.org/d/cms.txt")).alias("x")).collect()] == ["https://h.org/a.json", "https://h.org/d/b.csv", "https://z/q"]


def test_settings():
    s = settings_from({"elective_only": "No", "min_volume": "3", "weight_clinical": "1.0", "procedure_codes": "324, 326,"})
    assert (s.elective_only, s.min_volume, s.weight_clinical, s.procedure_codes, s.procedure_floor) == (False, 3, 1.0, (324, 326), 5)
    assert words(" a, ,b") == ("a", "b")
    with pytest.raises(KeyError):
        settings_from({"nothing": "1"})
    assert resolve_releases("2022", {2022: "x"}) == {"2022": "x"} and resolve_releases(None, {2022: "x"}, "y") == {"explicit": "y"}
    with pytest.raises(ValueError):
        resolve_releases("2021", {2022: "x"})


def test_word_set_similarity():
    assert token_set_similarity("mount sinai", "sinai mount queens") == 100.0
    assert token_set_similarity("", "a") == 0.0
    assert token_set_similarity("abcd", "abcx") == 75.0
    assert 60 < token_set_similarity("newyork presbyterian columbia", "newyork presbyterian columbia university irving") <= 100


def test_price_file_heads():
    head = "hospital_name,license_number\nSample,330001\ndescription,code|1,standard_charge|gross\n"
    assert layout(head) == {"row": 2, "names": ["description", "code|1", "standard_charge|gross"], "facility": "Sample", "ccn": "330001"}
    with pytest.raises(ValueError):
        layout("a,b\nc,d\n")
    assert sniff(' {"a"', "x.csv") == "json" and sniff("a,b", "x.json") == "csv"
