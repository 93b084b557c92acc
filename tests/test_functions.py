from pyspark.sql import functions as F

from tidewater import functions as TF
from tidewater.plans.golden import parse_spec, split_spec_list


def one(spark, col, value="x", dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(col).first()[0]


def test_log_escape(spark):
    assert one(spark, TF.log_escape("v"), "a\nb\rc'd\"e;f$g") == "a\\nb\\rc d e f$g"


def test_ascii_lower_leaves_non_ascii(spark):
    assert one(spark, TF.ascii_lower("v"), "ÉA") == "Éa"
    assert one(spark, TF.normalise_line("v"), ' {"A": 1}\t') == '{"a":1}'


def test_default_unknown_and_exit_flag(spark):
    assert one(spark, TF.default_unknown("v"), "") == "Unknown"
    assert one(spark, TF.default_unknown("v"), None) == "Unknown"
    assert one(spark, TF.default_unknown("v"), "app") == "app"
    assert one(spark, TF.exit_ok("v"), 0, "int") is True
    assert one(spark, TF.exit_ok("v"), 2, "int") is False


def test_application_id(spark):
    log = "x\nINFO Submitting application application_1_0002 to ResourceManager\nmore"
    assert one(spark, TF.application_id("v"), log) == "application_1_0002"
    assert one(spark, TF.application_id("v"), "nothing") == "Unavailable"


def test_padded_status(spark):
    assert one(spark, TF.padded_status("v", F.lit("SUCCESS"), 10), "t1") == "t1         - SUCCESS"


def test_marker_and_routing(spark):
    assert one(spark, TF.marker_name("v", "csv"), "/top/landing/a1.csv") == "a1_DONE.csv"
    assert one(spark, TF.marker_name("v", "gz"), "/l/data.json") == "data_DONE.gz"
    assert one(spark, TF.route("v", "landing", "archive"), "/top/landing/sub/a.csv") == "/top/archive/a.csv"
    assert one(spark, TF.route("v", "landing", "failure"), "hdfs://nn/top/landing/a.csv") == \
        "hdfs://nn/top/failure/a.csv"


def test_spec_parse_first_and_last_pipe(spark):
    df = spark.createDataFrame([("t|a, b|c|x = 1",), ("t|x = 1",), ("t||",)], "spec string")
    got = [(r["table_name"], r["fields"], r["condition"]) for r in TF.parse_specs(df).collect()]
    assert got == [("t", "a, b|c", "x = 1"), ("t", "", "x = 1"), ("t", "", "")]
    assert parse_spec("t|a, b|c|x = 1") == ("t", "a, b|c", "x = 1")
    assert parse_spec("t|x") == ("t", "", "x")


def test_spec_list_and_collection_line(spark):
    assert split_spec_list("a|b|~~c|d|e~") == ["a|b|", "c|d|e"]
    df = spark.createDataFrame([("a|b|~~c|d|e~",)], "s string")
    assert [r["spec"] for r in TF.explode_spec_list(df, "s").collect()] == ["a|b|", "c|d|e"]
    assert one(spark, TF.collection_name("v"), "col,select?q=a,b") == "col"
    assert one(spark, TF.collection_query("v"), "col,select?q=a,b") == "b"


def test_epoch_seconds_utc_and_bad_text(spark):
    assert one(spark, TF.epoch_seconds("v"), "1990-01-01 00:00:00") == 631152000
    assert one(spark, TF.epoch_seconds("v"), "junk") is None
