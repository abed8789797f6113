from datetime import datetime

from pyspark.sql import functions as F, types as T

from conftest import rows
from tidewright.functions import sixbit
from tidewright.operators.decode import (check_integrity, decode_bits, parse_document, reassemble_parts,
                                         route_rejects, split_fields)
from tidewright.plans.layouts import POSITION_REPORT, STATIC_REPORT

SENTENCE = "!AIVDM,1,1,,B,177KQJ5000G?tO`K>RA1wUbN0TKH,0*5C"


def test_checksum_accepts_the_known_sentence_and_nothing_else(spark):
    lines = [SENTENCE, SENTENCE[:-1] + "D", SENTENCE[:-3], "", None, "$GP*17"]
    got = check_integrity(spark.createDataFrame([(x,) for x in lines], "raw string"), "raw")
    assert dict((r.raw, r.error) for r in got.collect()) == {
        SENTENCE: None, SENTENCE[:-1] + "D": "wrong checksum", SENTENCE[:-3]: "malformed sentence",
        "": "malformed sentence", None: "malformed sentence", "$GP*17": None}


def test_position_report_of_the_known_sentence(spark):
    line = spark.createDataFrame([(SENTENCE,)], "raw string").select(F.split("raw", ",")[5].alias("p"))
    r = decode_bits(line, "p", POSITION_REPORT).first()
    assert (r.msg_type, r.entity_key, r.status, r.course, r.heading, r.second, r.error) == (
        1, 477553000, 5, 51.0, 181, 15, None)
    assert abs(r.lon + 122.345833) < 1e-6 and abs(r.lat - 47.582833) < 1e-6


def test_bad_payloads_give_nulls_and_a_reason(spark):
    got = decode_bits(spark.createDataFrame([("",), (None,), ("17", ), ("1~7KQJ5000G?tO`K>RA1wUbN0TKH",)], "p string"),
                      "p", POSITION_REPORT)
    assert [r.error for r in got.collect()] == ["no payload", "no payload", "cut short", "illegal character"]
    assert [r.msg_type for r in got.collect()] == [None, None, 1, None]


def test_signed_text_and_missing_fields_round_trip(spark):
    layout = [sixbit.Field("a", 0, 7, "int"), sixbit.Field("name", 7, 24, "text"), sixbit.Field("b", 31, 11, missing=2047)]
    cases = [(-64, "AB ", 0), (63, "SHIP", 2046), (-1, "Q", 2047), (0, "", 5)]
    df = spark.createDataFrame(cases, "a int, name string, b int")

    def letter(i):
        c = F.ascii(F.substring(F.rpad("name", 4, "@"), i + 1, 1))
        return F.when(c >= 64, c - 64).otherwise(c)

    parts = [sixbit.Field("a", 0, 7), *[sixbit.Field(f"c{i}", 7 + 6 * i, 6) for i in range(4)], sixbit.Field("b", 31, 11)]
    values = {"a": F.pmod(F.col("a"), F.lit(128)), "b": F.col("b"), **{f"c{i}": letter(i) for i in range(4)}}
    packed = df.select(sixbit.encode(parts, values, 7).alias("p"))
    got = [(r.a, r.name, r.b) for r in decode_bits(packed, "p", layout).collect()]
    assert got == [(-64, "AB", 0), (63, "SHIP", 2046), (-1, "Q", None), (0, "", 5)]


def test_static_layout_fits_its_payload():
    assert max(f.start + f.width for f in STATIC_REPORT) <= 424


def test_parts_join_in_order_whatever_their_arrival(spark):
    t = lambda s: datetime(2024, 1, 1, 0, 0, s)
    parts = [("a", 7, t(2), 2, 3, "BB"), ("a", 7, t(1), 1, 3, "AA"), ("a", 7, t(3), 3, 3, "CC"),
             ("a", 7, t(4), 2, 3, "bb"),                       # part 2 with another payload: of a message that lacks the rest
             ("a", 7, t(50), 1, 3, "again"),                   # the same number much later: another message
             ("b", None, t(1), 1, 1, "alone"), ("b", 9, t(1), 4, 3, "odd"), ("b", 8, t(1), None, 2, "none")]
    df = spark.createDataFrame(parts, "source string, seq_id int, ts timestamp, part_no int, n_parts int, payload string")
    whole = reassemble_parts(df, ["source", "seq_id"], "ts", "part_no", "n_parts", "payload", 10)
    good, bad = route_rejects(whole)
    assert rows(good, "source", "payload") == [("a", "AABBCC"), ("b", "alone")]
    assert rows(bad, "source", "seq_id", "n_present", "error") == [
        ("a", 7, 1, "incomplete"), ("a", 7, 1, "incomplete"), ("b", 8, 1, "bad part number"), ("b", 9, 1, "bad part number")]
    assert rows(bad.select(F.explode("parts.payload"))) == [("again",), ("bb",), ("none",), ("odd",)]


def test_lines_with_wrong_fields(spark):
    df = spark.createDataFrame([("1|x|2.5",), ("1|x",), ("q|x|",), (None,), ("1|x|2|3",)], "raw string")
    got = split_fields(df, "raw", "|", [("id", "bigint"), ("name", "string"), ("v", "double")])
    assert [tuple(r)[1:] for r in got.collect()] == [
        (1, "x", 2.5, None), (1, "x", None, "wrong number of fields"), (None, "x", None, "bad id"),
        (None, None, None, "no text"), (1, "x", 2.0, "wrong number of fields")]


def test_good_and_rejects_are_everything(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("{",), (None,), ('{"k": "x"}',)], "j string")
    parsed = parse_document(df, "j", T.StructType([T.StructField("k", T.LongType())]), "json")
    good, bad = route_rejects(parsed)
    assert good.count() + bad.count() == 4
    assert [r.doc.k for r in good.collect()] == [1]


def test_lines_are_decoded_once(spark):
    """What comes out reads stored tables: no stage before it is worked through again."""
    from datetime import datetime
    from tidewright.plans.sentences import decode_sentences
    lines = spark.createDataFrame([("a", datetime(2024, 1, 1), "no sentence"), ("a", datetime(2024, 1, 2), "!AIVDM,1,1,,A,x*00")],
                                  "source string, received_ts timestamp, raw string")
    tables = decode_sentences(lines)
    for name in ("obs", "static", "rejects"):
        plan = tables[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "RLIKE" not in plan and "unbase64" not in plan
    assert {(r.stage, r.error) for r in tables["rejects"].collect()} == {("integrity", "malformed sentence"), ("integrity", "wrong checksum")}
