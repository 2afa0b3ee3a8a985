"""Hand-derived values for the scalar functions, in column and in Python form."""

import json
import random
import tracemalloc
from difflib import SequenceMatcher

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as tx
from corpusloom.functions import udfs


def one(spark, rows, column, schema="s string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(column).collect()]


ODD = [None, "", " a 　b\u001cc\t\r\n d ", "x\u0085y z", "​q"]


def test_normalize(spark):
    want = ["", "", "a b c d", "x y z", "​q"]
    assert one(spark, ODD, tx.normalize_text(F.col("s"))) == want == [udfs.squeeze(s) for s in ODD]


def test_hangul(spark):
    texts = ["가", "한국어 ABC", "힣", "", "A가b"]
    want = ["ga", "hangugeo abc", "hih", "", "agab"]
    assert one(spark, texts, tx.romanize_hangul(F.col("s"))) == want == [udfs.romanize(t) for t in texts]
    assert len(tx.INITIALS) == 19 and len(tx.VOWELS) == 21 and len(tx.FINALS) == 28


def test_match_text(spark):
    texts = ["Héllo, 한-글! 12", "...", None, "a  B"]
    got = one(spark, texts, tx.match_text(F.col("s")))
    assert got == ["h llo han geur 12", "", "", "a b"] == [udfs.Comparable(t or "").roman for t in texts]


def test_asr_normal(spark):
    texts = ["Café, OK!", "a​b", "½ + 2", None, "１２"]
    assert one(spark, texts, udfs.asr_normalize("s")) == ["café ok", "ab", "½ 2", "", "１２"]
    assert udfs.asr_normal("a b, c", True) == "abc"


def test_sentences(spark):
    words = " ".join(f"w{k}" for k in range(25))
    got = one(spark, ["A b. C d? E", "Ends. ", words, "", None, "3.5 is one", "了。 好！ x"], tx.split_sentences(F.col("s")))
    assert got[0] == ["A b.", "C d?", "E"] and got[1] == ["Ends."] and [len(x.split()) for x in got[2]] == [12, 12, 1]
    assert got[3] == got[4] == [] and got[5] == ["3.5 is one"] and got[6] == ["了。", "好！", "x"]


def test_ratio_is_not_symmetric():
    assert udfs.text_ratio("tide", "diet") == 0.25 and udfs.text_ratio("diet", "tide") == 0.5
    same = "ab" * 150
    assert udfs.text_ratio(same, same) == 1.0 and udfs.text_ratio("x" + same, same + "y") < 0.01  # frequent characters don't anchor in long texts
    assert udfs.sequence_score(udfs.Comparable("a b"), udfs.Comparable("")) == 0.0
    assert udfs.sequence_score(udfs.Comparable("a b"), udfs.Comparable("a b")) == pytest.approx(1.0)


def test_paths(spark):
    docs = ['{"x": {"y": " v "}, "t": "z"}', '{"x": 3, "t": ""}', "{}", None, "not json"]
    value, path = tx.first_path(F.col("s"), ["x.y", "t"])
    assert one(spark, docs, F.struct(value, path)) == [("v", "x.y"), ("", ""), ("", ""), ("", ""), ("", "")]
    audio = tx.audio_path(F.col("s"), "라벨링데이터", "원천데이터")
    assert one(spark, ["/r/1.T/라벨링데이터_a/라벨링데이터/01.n/f.v2.json", "/r/x/f"], audio) == ["/r/1.T/원천데이터/라벨링데이터/01.n/f.v2.wav", "/r/x/f.wav"]
    assert one(spark, ["01.a.b", "name", "01. name"], F.struct(*tx.category(F.col("s")))) == [("01", "a.b"), ("name", "name"), ("01", "name")]


def test_speaker(spark):
    meta = tx.speaker_meta(F.col("doc"), F.col("s"))
    rows = [("a-b-c-d-S1-e-f-M-60-Seoul", "{}"), ("a-b-c", '{"Patient_info": null}'), ("a-b-c-d-S1-e-f-M--X", '{"Patient_info": {"SpeakerName": " N  1 ", "Age": 7}}')]
    got = one(spark, rows, F.struct(*(c.alias(n) for n, c in meta.items())), "s string, doc string")
    assert tuple(got[0]) == ("S1", "M", "60", "Seoul", "S1-M-60-Seoul")
    assert tuple(got[1]) == ("a-b-c", "", "", "", "a-b-c")
    assert tuple(got[2]) == ("N 1", "M", "7", "X", "N 1-M-7-X")


def test_small_ones(spark):
    assert one(spark, [(3661.9,), (-5.0,), (90061.0,)], tx.clock(F.col("s")), "s double") == ["01:01:01", "00:00:00", "25:01:01"]
    assert one(spark, [(300, "a/b")], tx.shard_path(F.col("i"), F.col("s")), "i bigint, s string") == ["audio/044/00000300_a_b.flac"]
    assert one(spark, [(0.12345,), (2.675,)], tx.stable_round(F.col("s"), 2), "s double") == [0.12, 2.68]
    assert one(spark, ['{"B": "1", "a": "2", "b": "3"}', "{}", None, "x"], tx.get_any_case(F.col("s"), "b")) == ["1", None, None, None]


def test_word_edits(spark):
    rows = [("a b c", "a x c d"), ("", "a b"), ("a b", ""), ("", ""), ("b a", "a b"), ("가 나", "가")]
    got = one(spark, rows, tx.word_edits(tx.words_of(F.col("r")), tx.words_of(F.col("h"))), "r string, h string")
    assert got == [2, 2, 2, 0, 2, 1]


def test_sql_names(spark):
    from corpusloom.functions.sql import register_sql

    register_sql(spark)
    row = spark.sql("SELECT hangul_romanize('한국 A') a, wer('a b  c', 'a x c d') b, cer('abcd', 'abd') c, wer('', 'a') d, asr_normalize('A, b') e, round(seq_ratio('a b', 'a b'), 6) f").first()
    assert tuple(row) == ("hangug a", 2 / 3, 0.25, None, "a b", 1.0)


def test_severity_search(spark):
    docs = [{"a": {"My_Level": ""}, "b": [{"x": 1}, {"중증도": " s "}]}, {"grade": {"k": 1}}, {"a": [[{"LEVEL": 0}]]}, {"a": None}]
    want = [("s", "b[1].중증도"), ("{'k': 1}", "grade"), ("0", "a[0][0].LEVEL"), ("", "")]
    assert [udfs.find_severity(d) for d in docs] == want
    assert [tuple(r) for r in one(spark, [json.dumps(d) for d in docs], udfs.severity_lookup("s"))] == want
    assert [tuple(r) for r in one(spark, ["{", None], udfs.severity_lookup("s"))] == [("", ""), ("", "")]


FULL = {"Instruction": "write it", "INPUT": "long enough", "cc": "a", "PI": ["b", "c"], "a&p": {"k": "d"}}


def test_salvage():
    body = json.dumps(FULL)
    assert udfs.salvage_json("SKIP: why") == "SKIP" and udfs.salvage_json(" SKIP") == "SKIP"
    assert udfs.salvage_json(body) == FULL == udfs.salvage_json(f"so: ```json\n{body}\n``` or {{") == udfs.salvage_json(f"x {{bad}} {body} y")
    assert udfs.salvage_json("[1]") is None and udfs.salvage_json("{") is None and udfs.salvage_json(None) is None
    assert udfs.salvage_json('[{"a": 1}]') == {"a": 1}


def test_validity():
    assert udfs.is_valid_record(FULL) and udfs.output_text(FULL) == "CC: a\nPI: b\nc\nA&P: k: d"
    assert not udfs.is_valid_record(FULL | {"QA_ID": 1}) and not udfs.is_valid_record({k: v for k, v in FULL.items() if k != "cc"})
    assert not udfs.is_valid_record(FULL | {"INPUT": "skip"}) and not udfs.is_valid_record(FULL | {"Instruction": "..."}) and not udfs.is_valid_record([1])
    given = {"instruction": "write it", "input": "long enough", "output": {"cc": "a", "pi": "b", "ap": "c"}}
    assert udfs.is_valid_record(given) and not udfs.is_valid_record(given | {"output": "CC: a PI: b"})
    assert not udfs.is_valid_record(given | {"input": udfs.PLACEHOLDERS[0]})


def test_flat_text():
    assert udfs.flat_text({"a": None, "b": [1, "", {"c": " x "}]}) == "b: 1\nc: x" and udfs.flat_text(None) == "" and udfs.flat_text(True) == "True"


def test_similarity_is_that_of_difflib():
    rng = random.Random(1)
    for _ in range(3000):
        letters = rng.choice(["ab", "abc", "abcdefgh ", "abcdefghijklmnopqrstuvwxyz "])
        make = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(0, rng.choice([5, 60, 260, 400]))))  # noqa: B023, E731
        a, b = make(), make()
        if rng.random() < 0.5 and a:
            b = "".join(rng.choice(letters) if rng.random() < 0.1 else c for c in a)
        assert udfs.text_ratio(a, b) == SequenceMatcher(None, a, b).ratio()
        x, y = udfs.Comparable(a), udfs.Comparable(b)
        assert y.ratio_of(x) == SequenceMatcher(None, x.roman, y.roman).ratio()


def test_word_edits_beyond_one_code_unit(spark):
    """65,536 different words and one more: its code must not fall on that of another word."""
    words = F.transform(F.sequence(F.lit(1), F.lit(65_536)), lambda k: F.concat(F.lit("w"), k.cast("string")))
    one = lambda *x: F.array(*map(F.lit, x))
    got = spark.range(1).select(tx.word_edits(words, one("new")).alias("a"), tx.word_edits(words, one("w65000", "new")).alias("b"), tx.word_edits(one(), one("x")).alias("c")).first()
    assert tuple(got) == (65_536, 65_535, 1)


def test_texts_are_python_objects_a_few_at_a_time(spark):
    """A batch of 30 MB: all its texts and results at once take three times as many."""
    udf = udfs.by_value(T.StringType(), "twice", lambda t: None if t is None else t + t)
    batch = pa.array(["한글" * 2500] * 998 + [None, ""])
    tracemalloc.start()
    n, at_most, last = 0, 0, None
    for out in udf.func(iter([batch, batch])):
        n, at_most, last = n + len(out), max(at_most, len(out)), out
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2000 and at_most <= udfs.AT_A_TIME and peak < 5e6 and last.to_pylist()[-2:] == [None, ""]
    rows = spark.createDataFrame([(k, f"A{k}, b" if k % 3 else None) for k in range(500)], "k int, t string").coalesce(1)
    assert {r.k: r.a for r in rows.select("k", udfs.asr_normalize("t").alias("a")).collect()} == {k: f"a{k} b" if k % 3 else "" for k in range(500)}
