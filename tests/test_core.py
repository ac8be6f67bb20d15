"""Operators of the core: hand-derived fixtures, brute force, failures between steps, nulls and clashing columns."""

import io
import random
import zipfile
from datetime import datetime
from difflib import SequenceMatcher

import pandas as pd
import pytest
from pyspark.sql import functions as F

from scriptoria.functions import replies
from scriptoria.functions.similarity import nfkc, ratio, self_repeat_ratio
from scriptoria.operators import dedupe, incremental, keys, layouts, ledger, lines, quality, references, review, skew, spec
from scriptoria.plans import documents, questions
from scriptoria.session import RELEASE, Scratch
from scriptoria.sources import files


def one(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


# increments

SCANS = "scan_id bigint, original_path string, file_hash string, change_type string, seen_at timestamp, state string"
MANIFEST = "file_hash string, pipeline_version string, processed_at string"
RUNS = "run_id bigint, pipeline_version string, started_at timestamp, finished_at timestamp, status string"


def day(n, h=0):
    return datetime(2026, 1, n, h)


def tables(spark):
    scans = [(1, "/a", "h1", "added", day(1), "x"), (2, "/a", "h2", "modified", day(2), "x"), (3, "/b", "h3", "added", day(1), "x"), (4, "/b", "h3", "removed", day(3), "x"), (5, "/c", "h4", "added", day(1), "x"), (6, "/d", "h1", "added", day(2), "x"), (6, "/d", "h1", "added", day(2), "x"), (7, "/e", None, "added", day(2), "x"), (8, None, "h9", "added", day(2), "x"), (9, "/f", "h5", "added", day(2), "x")]
    manifest = [("h4", "2", "2026-01-05T02:00:00+01:00"), ("H4 ", "2", "2026-01-05T01:00:00Z"), ("h1", "2", "2026-01-06T00:30:00Z"), ("h2", "1", "2026-01-05T00:30:00Z"), ("h5", "2", "bad time"), ("h5", "2", None)]
    runs = [(1, "1", day(1), day(1, 5), "succeeded"), (2, "2", day(5), day(5, 2), "succeeded"), (3, "2", day(6), day(6, 2), "failed"), (4, "2", day(7), None, "running")]
    return spark.createDataFrame(scans, SCANS), spark.createDataFrame(manifest, MANIFEST), spark.createDataFrame(runs, RUNS)


def test_pending_contents(spark):
    scans, manifest, runs = tables(spark)
    out = incremental.plan_next_run(spark, scans, manifest, runs, Scratch(spark, "i").path("s"))
    assert sorted(one(out, "file_hash")) == [("h1",), ("h2",), ("h5",)]
    empty = incremental.plan_next_run(spark, scans.limit(0), manifest.limit(0), runs.limit(0), Scratch(spark, "i").path("s"))
    assert empty.count() == 0


def test_runs_skip_and_repeat_nothing(spark):
    store = incremental.CommitStore(spark, Scratch(spark, "i").path("s"))
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(1, 6)], "n bigint, v string")
    copy = lambda part, before: (part, None)
    store.run(rows, "n", copy)
    more = rows.unionByName(spark.createDataFrame([(i, f"v{i}") for i in range(6, 9)], "n bigint, v string"))

    def fails(part, before):
        part.write.parquet(store.root + "/data/half")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.run(more, "n", fails)
    assert store.last()["watermark"] == 5
    bounds = store.begin(more, "n")
    late = more.unionByName(spark.createDataFrame([(9, "v9")], "n bigint, v string"))
    entry = store.commit(bounds, bounds.slice(late, "n"))
    assert sorted(one(spark.read.parquet(entry["output"]), "n")) == [(6,), (7,), (8,)]
    with pytest.raises(incremental.Lost):
        store.commit(bounds, bounds.slice(late, "n"))
    assert one(spark.read.parquet(store.run(late, "n", copy)["output"]), "n") == [(9,)]
    assert spark.read.parquet(store.run(late, "n", copy)["output"]).count() == 0


def test_state_is_carried_between_runs(spark):
    scans, manifest, runs = tables(spark)
    root = Scratch(spark, "i").path("s")
    first = incremental.plan_next_run(spark, scans.filter("scan_id <= 3"), manifest, runs, root)
    assert sorted(one(first, "file_hash")) == [("h2",), ("h3",)]
    assert sorted(one(incremental.plan_next_run(spark, scans, manifest, runs, root), "file_hash")) == [("h1",), ("h2",), ("h5",)]


# references


def test_orphans(spark):
    review = [("q1", " Q2", "d1", "p1", day(1), 1), ("q2", "gone", "d2", None, day(2), 1), ("q3", "  ", "D3 ", "", None, 1), (None, "gone", None, "p9", day(2), 1)]
    rows = spark.createDataFrame(review, "question_id string, duplicate_of_question_id string, document_id string, profile_id string, exported_at timestamp, key int")
    sources = spark.createDataFrame([("d1", None), ("d1", None), ("d2", day(3)), ("d3", None)], "document_id string, removed_at timestamp")
    profiles = spark.createDataFrame([("P1",)], "profile_id string")
    store = lambda: incremental.CommitStore(spark, Scratch(spark, "o").path("s"))
    got = set(one(references.find_orphans(rows, sources, profiles, store()), "ref_field", "question_id", "missing_key", "ref_month"))
    assert got == {("duplicate_of_question_id", "q2", "gone", "2026-01"), ("duplicate_of_question_id", None, "gone", "2026-01"), ("document_id", "q2", "d2", "2026-01"), ("profile_id", None, "p9", "2026-01")}
    assert references.find_orphans(rows.limit(0), sources, profiles, store()).count() == 0


def test_kept_counts_follow_changes(spark):
    review = [("q1", "q2", "d1", None, day(1)), ("q2", "q9", "d2", "p1", day(5)), ("q9", None, "d3", "p2", day(9)), ("q3", "none", "d1", None, None)]
    rows = spark.createDataFrame(review, "question_id string, duplicate_of_question_id string, document_id string, profile_id string, exported_at timestamp")
    sources = spark.createDataFrame([("d1", day(1), day(8)), ("d2", day(7), None), ("d3", day(1), day(2))], "document_id string, ingested_at timestamp, removed_at timestamp")
    profiles = spark.createDataFrame([("p1", day(2)), ("p2", None)], "profile_id string, created_at timestamp")
    store = incremental.CommitStore(spark, Scratch(spark, "o").path("s"))
    got = set(one(references.orphan_counts_over_time(rows, sources, profiles, store), "step", "ref_field", "orphans", "references"))
    assert got == {(1, "duplicate_of_question_id", 1, 1), (1, "document_id", 1, 1), (1, "profile_id", 0, 0), (2, "duplicate_of_question_id", 1, 1), (2, "document_id", 2, 3), (2, "profile_id", 0, 0)}
    before = store.last()
    assert store.apply(2, references.orphan_step([])) == before  # a run that is repeated changes nothing


def test_rows_without_number_come_once(spark):
    store = incremental.CommitStore(spark, Scratch(spark, "i").path("s"))
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "x"), (None, "x")], "n bigint, v string")
    took = lambda df: sorted(one(spark.read.parquet(store.run(df, "n", lambda part, before: (part, None))["output"]), "v"))
    assert took(rows) == [("a",), ("b",), ("x",)]
    assert took(rows) == []
    assert took(rows.unionByName(spark.createDataFrame([(None, "y"), (3, "c")], "n bigint, v string"))) == [("c",), ("y",)]


def test_signed_deltas_follow_late_targets(spark):
    refs = spark.createDataFrame([("q1", "k"), ("q2", "k")], "id string, f string")
    target = spark.createDataFrame([("k",)], "t string")
    state = references.merge_counts(None, references.reference_deltas(refs, ["f"]))
    assert one(references.orphan_keys(state), "key") == [("k",)]
    state = references.merge_counts(state, references.target_deltas(target, "f", "t"))
    assert references.orphan_keys(state).count() == 0
    state = references.merge_counts(state, references.target_deltas(target, "f", "t", -1))
    assert one(references.orphan_keys(state), "key") == [("k",)]
    assert references.merge_counts(state, references.reference_deltas(refs, ["f"], -1)).count() == 0


def test_salted_join_equals_join(spark, monkeypatch):
    monkeypatch.setattr(skew, "HARMLESS", 10)
    left = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(300)] + [(None, 1)], "k string, i int")
    right = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k0", "c"), (None, "d")], "k string, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert sorted(map(str, skew.salted_join(left, right, "k", how).collect())) == sorted(map(str, left.join(right, "k", how).collect()))
    assert one(skew.hot_keys(left, "k"), "k") == [("hot",)] and skew.hot_keys(right, "k") is None


# text gate

GATE = [
    (None, "empty_extraction"), ("short", "too_short"), ("abcdefghij" * 9 + "klmnopq" + "�" * 3, "replacement_chars:0.030"), ("abcdefghij" * 9 + "klmnopqrs" + "�", None),
    ("abcdefghij" * 9 + "klmnopq" + "\x01" * 3, "control_chars:0.030"), ("ab" * 100, "repeated_char_spam:0.50"), ("☃" * 20 + "abcdefgh" * 10, "high_noise_ratio:0.20"), ("aabcd" * 20, None),
]


def test_gate(spark):
    df = spark.createDataFrame([(i, t, 1) for i, (t, _) in enumerate(GATE)], "i int, text string, clash int")
    got = {r.i: r.q_reason for r in quality.assess(df).collect()}
    assert got == {i: r for i, (_, r) in enumerate(GATE)}


def test_gate_confidence(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(500))
    df = spark.createDataFrame([("x" + text[:498] + "y",), ("x" + text[:68] + "y",)], "text string")
    assert [round(r.q_confidence, 3) for r in quality.assess(df).collect()] == [0.9, 0.599]


# lines and questions

D1 = [
    ("D1", 1, "M.C.Q's\n1- Which bone is longest?\na- Femur\nb- Tibia\nc- Ulna\nd- Radius\n2- The heart has\nfour parts called:\na- lobes\nb- chambers\nof muscle\nc- valves\nd- veins"),
    ("D1", 2, "3- Stem without d\na- x\nb- y\nc- z\nModel answers\n1-a 2-\nb\n3-c 9-d\nFill in the blanks\n1- The study of cells is ....\nModel answers\n1- Cytology"),
]


def content(spark, rows):
    df = lines.explode_lines(spark.createDataFrame(rows, "document_id string, page int, text string"))
    return lines.assign_sections(lines.content_lines(lines.mark_furniture(df, lines.running_lines(df))))


def segmented(spark, rows):
    q, unmatched, notes = questions.segment(content(spark, rows), Scratch(spark, "tq"))
    return {r.question_id: r for r in q.collect()}, set(one(unmatched, "raw_token", "raw_value", "section_type", "page")), set(one(notes, "anomaly"))


def test_headered_document(spark):
    q, unmatched, notes = segmented(spark, D1)
    got = {k: (r.question_text, [tuple(o) for o in r.options], r.source_answer, r.pages, r.anomalies) for k, r in q.items()}
    assert got == {
        "D1-mcq-1": ("Which bone is longest?", [("a", "Femur"), ("b", "Tibia"), ("c", "Ulna"), ("d", "Radius")], "a", [1], []),
        "D1-mcq-2": ("The heart has four parts called:", [("a", "lobes"), ("b", "chambers of muscle"), ("c", "valves"), ("d", "veins")], "b", [1], []),
        "D1-mcq-3": ("Stem without d", [("a", "x"), ("b", "y"), ("c", "z")], "c", [2], ["unexpected_option_count:3"]),
        "D1-fib-1": ("The study of cells is ....", [], "Cytology", [2], []),
    }
    assert unmatched == {("9", "d", "mcq", 2)} and notes == set()
    reasons = questions.review_reasons(*questions.segment(content(spark, D1), Scratch(spark, "tq")))
    assert set(one(reasons, "reason")) == {("D1-mcq-3:unexpected_option_count:3",), ("unmatched_answer_key:9@p2",)}


def grouped_document():
    option = "\n".join(f"{x}- option {x}" for x in "abcd")
    questions = lambda n: "\n".join(f"{i}- Question {i}?\n{option}" for i in range(1, n + 1))
    return [("D2", 1, f"Spinal cord\n{questions(3)}\nBrain stem\n{questions(2)}\nModel answer\nSpinal cord\n1-a\n2-b\n3-a & c\nBrain stem\n1-d\n7-a")]


def test_chapters_and_grouped_key(spark):
    q, unmatched, notes = segmented(spark, grouped_document())
    assert {k: r.source_answer for k, r in q.items()} == {"D2-mcq-spinal-cord-1": "a", "D2-mcq-spinal-cord-2": "b", "D2-mcq-spinal-cord-3": "a & c", "D2-mcq-brain-stem-1": "d", "D2-mcq-brain-stem-2": None}
    assert all(r.options[-1].text == "option d" and not r.anomalies for r in q.values())
    assert unmatched == {("Brain stem:7", "a", "mcq", 1)} and notes == set()


def test_chapters_with_other_labels(spark):
    (doc, page, text), = grouped_document()
    text = text.replace("Model answer\nSpinal cord\n", "Model answer\nSpinal cords\n2-c\n").replace("Brain stem\n1-d", "Liver\n1-d").replace("Brain stem", "Bráin ﬁeld")
    q, unmatched, notes = segmented(spark, [(doc, page, text)])
    assert {k: r.source_answer for k, r in q.items()} == {"D2-mcq-spinal-cord-1": "a", "D2-mcq-spinal-cord-2": "c", "D2-mcq-spinal-cord-3": "a & c", "D2-mcq-br-in-field-1": None, "D2-mcq-br-in-field-2": None}
    assert notes == {("answer_key_group_unmatched:Liver",), ("no_answer_key_for_group:Bráin ﬁeld",), ("answer_key_repeat_conflict:Spinal cords-2:c_vs_b",)}
    _, labels = None, spark.createDataFrame([("d", "spinalcord"), ("d", "liver")], "document_id string, label_key string")
    assert set(one(keys.match_labels(spark.createDataFrame([("d", "spinalcords"), ("d", "lung"), (None, "x")], "document_id string, label_key string"), labels), "label_key", "content_key")) == {("spinalcords", "spinalcord")}


def test_conflicting_keys_of_sections(spark):
    text = "M.C.Q's\n1- One?\na- p\nb- q\nc- r\nd- s\nModel answers\n1-a\nM.C.Q's\n2- Two?\na- p\nb- q\nc- r\nd- s\nModel answers\n1-b 2-c so-d 2-d"
    q, unmatched, _ = segmented(spark, [("D6", 1, text)])
    assert {k: (r.source_answer, r.anomalies) for k, r in q.items()} == {"D6-mcq-1": ("b", ["conflicting_answer_key_value:a_vs_b"]), "D6-mcq-2": ("d", [])}
    assert unmatched == {("so", "d", "mcq", 1)}


@pytest.mark.parametrize(("extra", "anomalies"), [("", []), ("3- Lateral\n", ["unpaired_left_item:3"])])
def test_matching(spark, extra, anomalies):
    text = f"Cross matching\n1- Match the item in (A) with (B):\n(A)\n(B)\n1- Supine\nA- Lying face up\n2- Prone\nB- Lying face down\n{extra}Model answers\n(1)\n1-B\n2-A"
    r = lines.matching_records(lines.question_blocks(content(spark, [("D3", 1, text)]))).collect()[0]
    assert r.question_text == "Match the item in (A) with (B):" and [tuple(p) for p in r.pairs] == [("1", "Supine", "A", "Lying face up"), ("2", "Prone", "B", "Lying face down")] and r.anomalies == anomalies


@pytest.mark.parametrize(("key", "answers", "ambiguous", "left"), [
    ("(1) (2)\n1-A 1-B 2-C", {"D4-match-1": "1-A,2-C", "D4-match-2": "1-B"}, set(), set()),
    ("(1) (2)\n1-A 1-B", {"D4-match-1": "1-A", "D4-match-2": "1-B"}, {"D4-match-1", "D4-match-2"}, set()),
    ("9-Z (1)\n1-A 2-C\n(2)\n1-B (3) 1-D", {"D4-match-1": "1-A,2-C", "D4-match-2": "1-B"}, set(), {("(3)", "1-D", "matching", 1)}),
    ("no key", {"D4-match-1": None, "D4-match-2": None}, set(), set()),
])
def test_matching_keys(spark, key, answers, ambiguous, left):
    text = f"Cross matching\n1- Match one:\n1- p\nA- x\n2- q\nC- y\n2- Match two:\n1- r\nB- z\nModel answers\n{key}"
    q, unmatched, _ = segmented(spark, [("D4", 1, text)])
    assert {k: r.source_answer for k, r in q.items()} == answers and unmatched == left
    assert {k for k, r in q.items() if r.anomalies} == ambiguous


def test_round_robin(spark):
    batches = [("a", [("1", 2), ("2", 1)], ["1-A", "1-B", "2-C"]), ("b", [("1", 2), ("2", 1)], ["1-A", "1-B"]), ("c", [("1", None)], []), ("d", [], ["1-A"])]
    df = spark.createDataFrame(batches, "batch_id string, expected array<struct<grp:string,n:int>>, tokens array<string>")
    assert set(one(keys.round_robin_key(df), "batch_id", "grp", "answer", "ambiguous")) == {("a", "1", "1-A,2-C", False), ("a", "2", "1-B", False), ("b", "1", "1-A", True), ("b", "2", "1-B", True), ("c", "1", "", True)}


def test_gaps_and_letters(spark):
    t = spark.createDataFrame([("d", 1, p, n, "a") for p, ns in ((1, "48 49 51"), (2, "1 2 3"), (3, "1 4"), (4, "5"), (5, "so 7")) for n in ns.split()], "document_id string, section int, page int, number string, answer string")
    assert one(keys.sequence_gaps(t), "page", "gap") == [(1, 50)]
    q = spark.createDataFrame([("q1", "a & c", [("a", "x"), ("b", "y")]), ("q2", None, [])], "question_id string, source_answer string, options array<struct<label:string,text:string>>")
    assert one(keys.answers_not_in_options(q), "question_id", "bad_letters") == [("q1", ["c"]), ("q2", None)]


def test_running_lines_need_pages_and_share(spark):
    rows = [("d", i, f"Head Line.\nbody {'abcdefghij'[i]}\n{i}") for i in range(4)] + [("e", i, "Head Line" if i < 2 else "other " * i) for i in range(4)] + [("f", 1, None), (None, 1, "x")]
    df = lines.explode_lines(spark.createDataFrame(rows, "document_id string, page int, text string"))
    run = lines.running_lines(df)
    assert one(run, "document_id", "norm", "n_pages", "doc_pages") == [("d", "head line", 4, 4)]
    assert lines.mark_furniture(df, run).filter("document_id = 'd' and furniture").count() == 8


# duplicates


def test_duplicate_resolution(spark):
    option = "\n".join(f"{x}- option {x}" for x in "abcd")
    same, other = f"3- What is the longest bone?\n{option}", f"3- Name two enzymes of the liver\n{option}"
    q, _, notes = segmented(spark, [("D5", 1, f"M.C.Q's\n{same}"), ("D5", 4, f"{same}\n{other}\nModel answers\n3-a")])
    assert {k: (r.pages, r.number, r.source_answer) for k, r in q.items()} == {"D5-mcq-3": ([1, 4], "3", "a"), "D5-mcq-3~conflict1": ([4], "3~conflict1", None)}
    assert q["D5-mcq-3"].anomalies[0] == "duplicate_question_merged:sim_1.00" and q["D5-mcq-3"].anomalies[1].endswith("conflicts_with=D5-mcq-3~conflict1")
    assert q["D5-mcq-3~conflict1"].anomalies[0].endswith("conflicts_with=D5-mcq-3") and notes == {("mcq_q3_conflicting_duplicates",)}


def test_questions_of_empty_and_untyped_pages(spark):
    q, unmatched, notes = segmented(spark, [("D8", 1, "only some prose\nof no kind"), ("D9", 1, None), (None, 1, "x"), ("D9", 2, "")])
    assert not q and not unmatched and ("no_sections_detected",) in notes


def test_blocks_copies_and_similarity(spark):
    block, near = "the same block of text " * 4, "the same block of tixt " * 4
    df = spark.createDataFrame([(1, f"{block}\n\nshort\n\n{block}"), (2, f"{block}\n\n{near}"), (3, None), (4, "")], "i int, text string")
    assert one(dedupe.repeated_blocks(df, ["i"]), "i", "first_block", "second_block") == [(1, 0, 1)]
    assert set(one(dedupe.repeated_blocks(df, ["i"], least=0.9), "i", "first_block", "second_block")) == {(1, 0, 1), (2, 0, 1)}
    assert set(one(dedupe.exact_copies(df.unionByName(df.selectExpr("i + 10 as i", "text")), "i", F.col("text")), "i", "keeper", "copies")) == {(k, k % 10, 2) for i in (1, 2, 4) for k in (i, i + 10)}
    pairs = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), (None, "x")], "a string, b string")
    assert one(pairs.select(ratio("a", "b").alias("r")), "r") == [(0.25,), (0.5,), (None,)]
    assert one(df.select(self_repeat_ratio()(F.lit("one two three four five six seven " * 2)).alias("r")).limit(1), "r") == [(1.0,)]
    assert one(spark.createDataFrame([("ﬁｘ",), (None,)], "t string").select(nfkc("t").alias("t")), "t") == [("fix",), (None,)]


# ledgers, layouts, replies, files


def test_leaky_bucket(spark):
    rows = [("m", 0, 10), ("m", 4, 5), ("m", 20, 3), ("m", 21, 0), ("n", 5, None)]
    df = spark.createDataFrame([(k, t * 1_000_000, a) for k, t, a in rows], "k string, t bigint, a bigint")
    got = sorted(one(ledger.leaky_levels(df, ["k"], "t", "a", ["t"], 60, 60), "k", "t", "level"))
    assert got == [("m", 0, 10_000_000), ("m", 4_000_000, 11_000_000), ("m", 20_000_000, 3_000_000), ("m", 21_000_000, 2_000_000), ("n", 5_000_000, 0)]


def test_leaky_bucket_agrees_with_a_loop(spark):
    rng = random.Random(2)
    rows = [(f"k{i % 5}", i * 977_777, rng.randint(0, 9)) for i in range(400)]
    got = {(r.k, r.t): r.level for r in ledger.leaky_levels(spark.createDataFrame(rows, "k string, t bigint, a bigint"), ["k"], "t", "a", ["t"], 60, 60).collect()}
    level, last = {}, {}
    for k, t, a in rows:
        level[k] = max(0, level.get(k, 0) - (t - last.get(k, t))) + a * 1_000_000
        last[k] = t
        assert got[k, t] == level[k]


def test_waits_and_intervals(spark):
    w = spark.createDataFrame([(1, 1, "a", 30.0), (1, 2, "b", 10.0), (2, 1, "a", 500.0), (3, 1, "a", 50.0), (3, 2, "b", 40.0)], "request int, priority int, model string, wait double")
    assert sorted(one(ledger.first_usable(w), "request", "model"), key=str) == [(1, "b"), (2, None), (3, "b")]
    s = spark.createDataFrame([("k", 1, 3), ("k", 3, 5), ("k", 7, 8), ("k", 2, 4)], "k string, b int, f int")
    assert sorted(one(ledger.merge_intervals(s, ["k"], "b", "f"), "b", "f")) == [(1, 5), (7, 8)]
    c = spark.createDataFrame([("a", 5.0), ("a", 9.0), ("b", 1.0)], "model string, until double")
    assert one(ledger.live_cooldowns(c, 4.0), "model", "seconds_left") == [("a", 5.0)]


def test_layout_rules_and_patterns(spark):
    stem, option = layouts.Marker("number", "Q", "(", ")"), layouts.Marker("lower", "", "", ".)")
    assert not layouts.Layout(stem, option, {"m.c.q": "mcq"}).problems()
    bad = layouts.Layout(layouts.Marker(open="(", closers="-"), None, {"m.c.q": "mcq", "": "other"}, key_mode="section")
    assert len(bad.problems()) >= 4
    df = spark.createDataFrame([("Q (12) text",), ("a) opt",), ("A) opt",)], "t string")
    assert one(df.select(F.regexp_extract("t", stem.pattern(), 1).alias("n"), F.regexp_extract("t", option.pattern(), 1).alias("o")), "n", "o") == [("12", ""), ("", "a"), ("", "")]
    marks = spark.createDataFrame([("x *",), ("* x",), ("x",), (None,)], "t string")
    for first, expected in ((False, [("x", True), ("* x", False), ("x", False), (None, None)]), (True, [("x *", False), ("x", True), ("x", False), (None, None)])):
        text, marked = layouts.take_mark(F.col("t"), "*", first)
        assert one(marks.select(text.alias("t"), marked.alias("m")), "t", "m") == expected


def extracted(spark, pages, layout):
    df = lines.explode_lines(spark.createDataFrame(pages, "document_id string, page int, text string"))
    marked = lines.mark_furniture(df, lines.running_lines(df))
    q, unmatched, notes = questions.extract_with_layout(marked, layout, Scratch(spark, "tl"))
    return {r.question_id: r for r in q.collect()}, set(one(unmatched, "raw_token", "raw_value", "page")), {x for x, in one(notes, "anomaly")}


NUMBER, LETTER = layouts.Marker("number", "", "", "-"), layouts.Marker("lower", "", "", "-")


def test_layout_of_chapters(spark):
    layout = layouts.Layout(NUMBER, LETTER, {"Questions": "mcq", "Model answer": "answer_key"}, "section", "-", grouped=True)
    (doc, page, text), = grouped_document()
    q, unmatched, notes = extracted(spark, [(doc, page, "Questions\n" + text)], layout)
    assert {k: r.source_answer for k, r in q.items()} == {"D2-mcq-spinal-cord-1": "a", "D2-mcq-spinal-cord-2": "b", "D2-mcq-spinal-cord-3": "a & c", "D2-mcq-brain-stem-1": "d", "D2-mcq-brain-stem-2": None}
    assert q["D2-mcq-brain-stem-2"].anomalies == ["no_answer_key_entry"] and unmatched == {("Brain stem:7", "a", 1)} and notes == set()


def test_layout_with_nearly_equal_headers_and_entries_across_pages(spark):
    layout = layouts.Layout(NUMBER, LETTER, {"Multiple choice": "mcq", "Answer sheet": "answer_key"}, "section", "-")
    option = "\n".join(f"{x}- option {x}" for x in "abc")
    text = f"Multiple ch0ice\n1- One?\n{option}\n2- Two?\n{option}\n3- Three?\n{option}\nd- more"
    q, unmatched, notes = extracted(spark, [("L", 1, text), ("L", 2, "Answer sheet\n1-a 2-"), ("L", 3, "b 1-c\n3-e 9-a")], layout)
    assert {k: (r.source_answer, r.anomalies) for k, r in q.items()} == {"L-mcq-1": ("a", []), "L-mcq-2": ("b", []), "L-mcq-3": ("e", ["unexpected_option_count:4", "answer_not_in_options:e"])}
    assert unmatched == {("9", "a", 3)} and notes == {"fuzzy_section_header:Multiple ch0ice->multiple choice", "answer_key_repeat_conflict:1:a_vs_c"}
    assert (q["L-mcq-1"].first_ref, q["L-mcq-1"].last_ref) == ("p1:1", "p1:4")
    with pytest.raises(ValueError):
        extracted(spark, [("L", 1, text)], layouts.Layout(NUMBER, None, {"x": "mcq"}))


def test_only_texts_near_a_header_are_compared(spark, monkeypatch):
    compared = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def counted(a: pd.Series, b: pd.Series) -> pd.Series:
        compared.add(len(a))
        return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")

    monkeypatch.setattr(spec, "ratio", counted)
    texts = [f"Line {i} of a text" for i in range(300)] + ["** Model  Answers:", "Model ansvers", "ﬁll in the blanks", "Für alles andere"]
    rows = spark.createDataFrame([("d", 1, i, t, False) for i, t in enumerate(texts)], "document_id string, page int, idx int, text string, furniture boolean")
    layout = layouts.Layout(layouts.Marker(), layouts.Marker("both"), {"Model answers": "answer_key", "Fill in the blanks": "fill_in_blank", "***": "mcq"}, "section", "-")
    body, notes = spec.layout_sections(rows, layout, Scratch(spark, "tn"))
    assert sorted(r.idx for r in body.collect()) == [*range(300), 303]
    assert {r.anomaly for r in notes.collect() if r.anomaly.startswith("fuzzy")} == {"fuzzy_section_header:Model ansvers->model answers"}
    assert 0 < compared.value <= 10


def test_layout_with_answers_beside_the_questions(spark):
    text = "Multiple choice\n1- One?\na- p\nb- q *\n2- Two?\na- p *\nb- q\nrest *\n3- Three?\na- p\nb- q"
    q, _, _ = extracted(spark, [("L", 1, text)], layouts.Layout(NUMBER, LETTER, {"Multiple choice": "mcq"}, "marked_option", mark="*"))
    assert {k: (r.source_answer, [o.text for o in r.options], r.anomalies) for k, r in q.items()} == {"L-mcq-1": ("b", ["p", "q"], []), "L-mcq-2": ("a & b", ["p", "q rest"], ["multiple_marked_options:a,b"]), "L-mcq-3": (None, ["p", "q"], ["no_answer_key_entry"])}
    text = "Multiple choice\n1- One?\na- p\nb- q\nAns: (B)\nFill in\n1- The .... bone\nAns: femur\n2- None"
    q, _, _ = extracted(spark, [("L", 1, text)], layouts.Layout(NUMBER, LETTER, {"Multiple choice": "mcq", "Fill in": "fill_in_blank"}, "inline_label", prefixes=("Ans", "Answer")))
    assert {k: (r.question_text, r.source_answer) for k, r in q.items()} == {"L-mcq-1": ("One?", "b"), "L-fib-1": ("The .... bone", "femur"), "L-fib-2": ("None", None)}


def test_entries_know_their_line(spark):
    rows = spark.createDataFrame([("d", 1, 0, "x 1-"), ("d", 1, 1, "a 2-b"), ("d", 2, 0, ""), ("d", 2, 1, "3-c")], "document_id string, page int, idx int, text string")
    from scriptoria.operators import spec

    pattern = spec.entry_pattern(layouts.Layout(NUMBER, LETTER, {}, "section", "-."))
    assert one(spec.tokens_with_lines(rows, ["document_id"], pattern), "number", "answer", "page", "idx") == [("1", "a", 1, 0), ("2", "b", 1, 1), ("3", "c", 2, 1)]


def test_signatures_and_matches(spark):
    df = lines.explode_lines(spark.createDataFrame(D1 + [("D9", 1, "plain text only here")], "document_id string, page int, text string"))
    rows = lines.mark_furniture(df, lines.running_lines(df))
    features = {r.document_id: r for r in layouts.layout_features(rows).collect()}
    assert features["D1"].stem_style == "||-" and features["D1"].opt_style == "lower||-" and features["D9"].stem_style is None
    sigs = layouts.signatures(layouts.layout_features(rows))
    got = layouts.match_layouts(sigs, layouts.layout_classes(sigs).filter("stem <> 'none'"))
    assert one(got, "document_id", "similarity", "rank") == [("D1", 1.0, 1)]


def test_validation(spark):
    q, _, _ = questions.segment(content(spark, D1), Scratch(spark, "tv"))
    none = F.lit(None).cast("string")
    df = lines.explode_lines(spark.createDataFrame([*D1, ("D7", 1, "some prose here\nand no question")], "document_id string, page int, text string"))
    marked = lines.mark_furniture(df, lines.running_lines(df))
    unmatched = spark.createDataFrame([("D1",)], "document_id string")
    report = layouts.validation_report(q.withColumn("first_ref", F.lit("p1:1")).withColumn("last_ref", F.when(F.col("number") == "3", "p9:9").otherwise("p1:2")), marked, layouts.layout_features(marked), unmatched)
    got = {(r.document_id, r.check): (round(r.value, 3), r.grade) for r in report.collect()}
    assert {k[1]: v for k, v in got.items() if k[0] == "D1"} == {
        "has_questions": (4, "pass"), "furniture_share": (0, "pass"), "content_coverage": (1, "pass"), "numbering_sequence": (1, "pass"), "option_shape": (1, "pass"), "empty_stems": (0, "pass"), "key_coverage": (1, "pass"),
        "option_count_consistency": got["D1", "option_count_consistency"], "key_resolution": (0.2, "warn"), "key_matches_options": (1, "pass"), "anomaly_rate": (0.25, "pass"), "key_gaps_explained": (0, "pass"), "provenance_integrity": (1, "fail"),
    }
    assert [v for k, v in got.items() if k[0] == "D7"] == [(0, "fail")]
    assert set(one(layouts.report_scores(report), "document_id", "verdict")) == {("D1", "fail"), ("D7", "fail")}
    assert dict(one(layouts.summary_line(report), "document_id", "summary"))["D1"].startswith("provenance_integrity=1.00 (fail); ")
    candidates = spark.createDataFrame([("a", "x", "weak", 0.9), ("a", "builtin", "pass", 0.8), ("a", "y", "pass", 0.8001), ("b", "x", "n/a", 1.0), ("b", "y", "fail", 0.1)], "document_id string, candidate string, verdict string, score double")
    assert set(one(layouts.best_candidates(candidates), "document_id", "candidate")) == {("a", "builtin"), ("b", "y")}


def test_coverage_tells_lost_lines(spark):
    df = lines.explode_lines(spark.createDataFrame([("d", 1, "1- What is the\nlongest bone?\na- femur *\nb- ulna\nlost line of text\n1-a 2-b\nLiver")], "document_id string, page int, text string")).withColumn("furniture", F.lit(False))
    pair = "array<struct<left_label:string,left_text:string,right_label:string,right_text:string>>"
    q = spark.createDataFrame([("d", "Liver", "What is the longest bone?", [("a", "femur"), ("b", "ulna")], None, [])], f"document_id string, label string, question_text string, options array<struct<label:string,text:string>>, source_answer string, pairs {pair}")
    got = one(layouts.content_coverage(df, q), "eligible_chars", "covered_chars")
    assert got == [(len("what is thelongest bonefemurulnalost line of text"), len("what is thelongest bonefemurulna"))]


@pytest.mark.parametrize("searched", [1 << 26, 0])
def test_coverage_shuffles_a_text_once(spark, monkeypatch, searched):
    monkeypatch.setattr(layouts, "SEARCHED", searched)
    rand = random.Random(4)
    words = ["os", "ossis", "tibia", "fibula", "Über", "naïve", "a", "humerus"]
    said = lambda n: " ".join(rand.choice(words) for _ in range(rand.randint(1, n)))
    docs = {d: ([said(5) for _ in range(40)], [said(30) for _ in range(6)] + [said(300)]) for d in ("d", "e", "f")}
    rows = [(d, 1, i, t, t, False) for d, (ls, _) in docs.items() for i, t in enumerate(ls)] + [(None, 1, 0, "tibia", "tibia", False), ("d", 1, 99, "tibia", "tibia", True), ("g", 1, 0, "os os", "os os", False)]
    df = spark.createDataFrame(rows, "document_id string, page int, idx int, text string, norm string, furniture boolean")
    pair = "array<struct<left_label:string,left_text:string,right_label:string,right_text:string>>"
    q = spark.createDataFrame([(d, docs[d][0][0], t, [], None, []) for d in docs for t in docs[d][1]] + [(None, None, "tibia", [], None, []), ("h", None, "os", [], None, [])], f"document_id string, label string, question_text string, options array<struct<label:string,text:string>>, source_answer string, pairs {pair}")
    out = layouts.content_coverage(df, q)
    want = {(None, 5, 0), ("g", 5, 0)}
    for d, (ls, texts) in docs.items():
        left = [t.lower() for t in ls if t != ls[0]]
        want.add((d, sum(map(len, left)), sum(len(t) for t in left if any(t in x.lower() for x in texts))))
    assert set(one(out, "document_id", "eligible_chars", "covered_chars")) == want
    # nothing is exploded into runs of characters, and no join multiplies a text
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 1 and " Join " not in plan


def test_scores_of_stored_questions(spark, tmp_path):
    page = "1- What is the\nlongest bone?\na- femur\nb- ulna\na line that was lost"
    spark.createDataFrame([("d", 1, page), ("d", 1, page), ("e", 1, None)], "document_id string, page int, text string").write.parquet(str(tmp_path / "page_extractions.parquet"))
    pair = "array<struct<left_label:string,left_text:string,right_label:string,right_text:string>>"
    kind = f"question_id string, document_id string, section_type string, group_label string, question_number string, question_text string, options array<struct<label:string,text:string>>, matching_pairs {pair}, source_answer string, anomalies array<string>, exported_at string, duplicate_of_question_id string"
    text = "What is the longest bone?" + " and so on" * 50
    q = [(f"q{i}", "d", "mcq", None, str(i), text, [("a", "femur"), ("b", "ulna")], [], "a", [], day, None) for i in (1, 2, 3) for day in ("1", "2")]
    spark.createDataFrame(q, kind).write.parquet(str(tmp_path / "needs_review.parquet"))
    out = documents.validation_scores(spark, str(tmp_path))
    (got,) = one(out, "document_id", "verdict", "score")
    assert got[:2] == ("d", "fail") and 0.5 < got[2] < 1
    # rows grow with the texts, not with their characters
    assert "sequence(1, greatest(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_marked_where_their_pages_are(spark, tmp_path, monkeypatch):
    rand = random.Random(7)
    pool = ["Anatomy of the limb", "anatomy  of the limb.", "1-a 2-b 3-c", "Answer: b", "12", "12 | Page", "```", ".", "x" * 61, "Liver", "a- femur", "\u00dcber"]
    rows = [(d, p, None if rand.random() < 0.1 else "\n".join(rand.choice(pool) if rand.random() < 0.7 else f"line {rand.random()}" for _ in range(rand.randint(0, 4)))) for d in ("a", "b", "c", None) for p in [*range(1, 12), None]]
    spark.createDataFrame([*rows, *rows[:9]], "document_id string, page int, text string").repartition(3).write.parquet(str(tmp_path / "page_extractions.parquet"))
    cut, plans = Scratch.cut, {}
    monkeypatch.setattr(Scratch, "cut", lambda self, df, name, *more, **named: plans.update({name: df._jdf.queryExecution().executedPlan().toString()}) or cut(self, df, name, *more, **named))
    order = ["document_id", "page", "idx", "text", "norm", "furniture"]
    got = sorted(map(repr, one(documents.lines_once(spark, str(tmp_path), Scratch(spark, "tm")), *order)))
    want = one(documents.lines_of(spark, str(tmp_path)), *order)
    assert got == sorted(map(repr, want)) and {r[0] for r in want if r[5] and r[3] == "Liver"} and not all(r[5] for r in want if r[3] == "Liver")
    # pages are shuffled once, their lines not at all
    assert list(plans) == ["lines"] and plans["lines"].count("Exchange hashpartitioning") == 1


def test_a_cut_leaves_no_shuffle_files(spark):
    def files_of(**how):
        seen = lambda: {x for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
        before = seen()
        out = Scratch(spark, "tr").cut(spark.range(1000).repartition("id").withColumn("n", F.lit(1)), "rows", **how)
        left = len(seen() - before)
        return out.count(), left

    assert files_of(release=True) == (1000, 0) and files_of()[1] > 0
    assert spark.conf.get(RELEASE, None) is None


def test_stored_questions_shuffle_what_they_hold(spark, tmp_path):
    text, day = "array<struct<label:string,text:string>>", "exported_at string, duplicate_of_question_id string"
    pair = "array<struct<left_label:string,left_text:string,right_label:string,right_text:string>>"
    kind = f"question_id string, document_id string, section_type string, group_label string, question_number string, question_text string, options {text}, matching_pairs {pair}, source_answer string, anomalies array<string>, {day}, ai_reviewed_at string"
    spark.createDataFrame([("q", "d", "mcq", None, "1", t, [("a", "x")], [], "a", [], t, None, "long ago") for t in ("1", "3", "2")], kind).write.parquet(str(tmp_path / "needs_review.parquet"))
    out = documents.stored_questions(spark, str(tmp_path))
    assert one(out, "question_id", "question_text", "source_answer") == [("q", "3", "a")]
    assert "ai_reviewed_at" not in out._jdf.queryExecution().executedPlan().toString()


def test_headers_references_and_applicability(spark):
    df = lines.explode_lines(spark.createDataFrame([("d", p, "Liver\n1- One?\na- x\nb- y\nKey\nBones") for p in (1, 2, 10)], "document_id string, page int, text string")).withColumn("furniture", F.col("text") == "Bones")
    assert one(layouts.header_candidates(df, 1), "norm", "n", "ref") == [("liver", 3, "p1:0")]
    assert one(layouts.header_candidates(df).filter("rank = 2"), "norm") == [("key",)]
    refs = spark.createDataFrame([("d", "p1:1", r"^\d+-"), ("d", "p1:0", r"^\d+-"), ("d", "p1:5", None), ("d", "p3:1", None), ("d", "x", None)], "document_id string, ref string, pattern string")
    assert set(one(layouts.ground(refs, df), "ref", "problem")) == {("p1:1", None), ("p1:0", "does_not_match"), ("p1:5", "furniture"), ("p3:1", "no_such_line"), ("x", "bad_reference")}
    assert one(layouts.applicable(df, layouts.Layout(NUMBER, LETTER, {"Liver": "mcq"})), "missing_headers", "stems", "options", "applies") == [(0, 3, 6, True)]
    assert one(layouts.applicable(df, layouts.Layout(NUMBER, LETTER, {"Lung": "mcq"})), "missing_headers", "applies") == [(1, False)]


def test_router(spark):
    def used(calls, models, **more):
        rows = [("s", n, float(t), 200, 630, 700) for n, t in enumerate(calls)]
        df = spark.createDataFrame(rows, "session string, n bigint, at double, prompt int, reserve int, used int")
        return [(r.model, r.started) for r in sorted(ledger.route_calls(df, models, **more).collect(), key=lambda r: r.n)]

    three = [(x, 30, 1000, 8000, 3000) for x in "ABC"]
    assert [m for m, _ in used([1e6] * 10 + [1e6 + 86405], three)] == [*"AAABBBCCC", None, "A"]
    two = [(x, 30, 1000, 8000, 200000) for x in "AB"]
    assert [m for m, _ in used([1e6] * 4 + [1e6 + 400], two, refuse={"A": 2})] == [*"AABB", "A"]
    paced = used([1e6] * 14, [("A", 30, 1000, 8000, 200000)])
    assert [m for m, _ in paced] == ["A"] * 14 and 0 < paced[-1][1] - 1e6 < 130

    requests = spark.createDataFrame([("r", 100.0, 830)], "request string, now double, tokens int")
    levels = spark.createDataFrame([("A", "tpd", 2100.0, 100.0), ("A", "tpd", 0.0, 1.0), ("B", "rpm", 27.0, 98.0)], "model string, dim string, level double, at double")
    cold = spark.createDataFrame([("C", 150.0), ("C", 120.0)], "model string, until double")
    got = {r.model: round(r.wait, 3) for r in ledger.budget_waits(requests, levels, cold, [*three, ("D", 30, 1000, 900, 3000)]).collect()}
    assert got == {"A": round((2930 - 2700) * 86400 / 3000, 3), "B": 0.0, "C": 50.0, "D": float("inf")}
    waits = ledger.budget_waits(requests, levels, cold, three)
    assert one(ledger.first_usable(waits), "model", "wait") == [("B", 0.0)]


def test_replies(spark):
    d = spark.createDataFrame([("2m59.56s",), ("250ms",), ("1h2m3s",), ("7",), ("junk",), (None,)], "t string")
    assert one(d.select(replies.parse_duration(F.col("t")).alias("s")), "s") == [(179.56,), (0.25,), (3723.0,), (7.0,), (None,), (None,)]
    v = [('{"agrees": true, "suggested": "B", "explanation": "e"}', True, "b", []), ('<think>{}</think>```json\n{"agrees": true, "suggested": "c", "explanation": "e"}```', False, "c", ["agrees_flag_inconsistent"]), ('{"agrees": false, "suggested": null, "explanation": "e"}', False, None, ["no_valid_suggested_option"]), ('{"agrees": true, "suggested": "z", "explanation": "e"}', True, None, ["suggested_answer_not_an_option", "no_valid_suggested_option"]), ('{"suggested": "z"}', None, None, None), ('{"agrees": true, "suggested": "b"}', True, "b", ["missing_explanation"])]
    df = spark.createDataFrame([(x[0], [(c, "t") for c in "abcd"], "b") for x in v], "r string, o array<struct<label:string,text:string>>, g string")
    got = [r.v for r in df.select(replies.normalize_verdict(F.col("r"), F.col("o"), F.col("g")).alias("v")).collect()]
    assert [(x.agrees, x.suggested, x.concerns) if x else (None, None, None) for x in got] == [x[1:] for x in v]
    r = spark.createDataFrame([('x {"confidence": 1.7, "concerns": ["a"], "notes": "n"} y',), ("no json",)], "t string")
    assert [x.v and x.v.confidence for x in r.select(replies.parse_review(F.col("t")).alias("v")).collect()] == [1.0, None]


def test_files_and_manifest(spark, tmp_path):
    ns = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    body = f'<w:document xmlns:w="{ns}"><w:body>{p("First")}{p("")}{p("Second")}<w:tbl><w:tr><w:tc>{p("c1")}</w:tc><w:tc>{p("c2")}</w:tc></w:tr></w:tbl></w:body></w:document>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", body)
    (tmp_path / "Anatomy" / "Arm").mkdir(parents=True)
    (tmp_path / "Anatomy" / "Arm" / "a.docx").write_bytes(buffer.getvalue())
    (tmp_path / "Anatomy" / "b.docx").write_bytes(b"broken")
    (tmp_path / "c.PNG").write_bytes(b"x")
    (tmp_path / "d.txt").write_bytes(b"x")
    scan = files.scan_files(spark, str(tmp_path))
    pages = {r.path.rsplit("/", 1)[1]: r for r in files.read_pages(scan).collect()}
    assert pages["a.docx"].text == "First\nSecond\nc1 | c2" and pages["b.docx"].error.startswith("BadZipFile") and pages["c.PNG"].extraction_method == "pending_vision" and pages["d.txt"].error == "unsupported_file_type"
    subject, topic = files.subject_topic(F.regexp_replace("path", "^file:", ""), str(tmp_path))
    assert set(one(scan.select(subject.alias("s"), topic.alias("t")), "s", "t")) == {("Anatomy", "Arm"), ("Anatomy", None), (None, None)}
    old = spark.createDataFrame([("h", "1", "2026-01-01T01:00:00+02:00"), ("g", "1", None)], "file_hash string, v string, processed_at string")
    new = spark.createDataFrame([("h", "2", "2026-01-01T00:00:00Z")], "file_hash string, v string, processed_at string")
    assert set(one(files.upsert_manifest(old, new), "file_hash", "v")) == {("h", "2"), ("g", "1")}
    files.write_json(old, str(tmp_path / "out"), "file_hash", 4)
    assert files.read_json(spark, str(tmp_path / "out"), "file_hash string, v string").count() == 2


def test_ingestion_of_files(spark):
    def docx(text):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>{text}</w:t></w:r></w:p></w:body></w:document>')
        return out.getvalue()

    long = "A text that is long enough to be read by everyone, with many letters."
    rows = [("/in/Anatomy/Limb/a.docx", "h1", "docx", docx(long)), ("/in/b.docx", "h2", "docx", b"broken"), ("/in/Anatomy/c.pdf", "h3", "pdf", b"x"), ("/in/z.docx", "h1", "docx", docx(long)), ("/in/old.docx", "h4", "docx", docx("x")), ("/in/n.txt", "h5", None, b"")]
    df = spark.createDataFrame(rows, "path string, file_hash string, file_type string, content binary")
    manifest = spark.createDataFrame([("h4", "/in/old.docx", "2", "2026-01-01T00:00:00Z"), ("h1", "/in/a", "1", "2026-01-01T00:00:00Z")], "file_hash string, original_path string, pipeline_version string, processed_at string")
    pages, bad, after = files.ingest(df, manifest, "2", "/in", "2026-02-01T00:00:00Z", pdf=lambda b: [long, "!!"])
    assert set(one(pages, "file_hash", "page", "subject", "topic", "extraction_method", "text")) == {("h1", 1, "Anatomy", "Limb", "docx_text", long), ("h3", 1, "Anatomy", None, "pdf_text", long), ("h3", 2, "Anatomy", None, "pending_vision", None)}
    assert one(bad, "path") == [("/in/b.docx",)]
    assert set(one(after, "file_hash", "pipeline_version")) == {("h1", "2"), ("h3", "2"), ("h4", "2")}


def test_review_and_checks(spark):
    option = "array<struct<label:string,text:string>>"
    q = spark.createDataFrame([("q1", "Which bone?", [("a", "femur"), ("b", "ulna")], "a"), ("q2", None, None, None)], f"question_id string, question_text string, options {option}, source_answer string")
    prompt = one(q.select(review.question_prompt(F.col("question_text"), F.col("options"), F.col("source_answer")).alias("p")), "p")
    assert prompt == [("Question: Which bone?\na) femur\nb) ulna\nAnswer: a",), ("Question: ",)]

    def model(p):
        if "Answer: b" in p:
            return '<think>x</think>{"suggested": "a", "explanation": "so"}'
        return '{"agrees": true, "suggested": "a", "explanation": "so"}'

    probes = review.probe_checker(q, model)
    assert set(one(probes, "question_id", "injected", "given", "agrees")) == {("q1", False, "a", True), ("q1", True, "b", False)}
    assert one(review.caught_rate(probes), "usable", "caught", "false_alarms") == [(2, 1.0, 0.0)]

    def fails(p):
        raise OSError("no service")

    assert set(one(review.ask(q.select("question_id", F.lit("p").alias("p")), "p", fails), "question_id", "reply", "error")) == {("q1", None, "OSError: no service"), ("q2", None, "OSError: no service")}
    rows = spark.createDataFrame([(0.9, ["x"], "", ["x", "y"]), (0.1, None, "seen", ["y"]), (0.9, None, None, [])], "confidence double, concerns array<string>, notes string, flags array<string>")
    assert one(review.merge_concerns(rows), "confidence", "concerns", "notes") == [(0.2, ["x", "y"], "structural: x, y"), (0.1, ["y"], "seen"), (0.9, [], None)]
    exports = [("q1", "t", [("a", "x")], "a", None, day(1), None), ("q1", "t", [("a", "y")], "a", True, day(2), None), ("q2", "t", None, None, True, day(1), None), ("q3", None, [], "a", None, None, None)]
    e = spark.createDataFrame(exports, f"question_id string, question_text string, options {option}, source_answer string, check_agrees boolean, exported_at timestamp, matching_pairs {option}")
    assert set(one(review.check_states(e), "question_id", "contents", "state")) == {("q1", 2, "changed"), ("q2", 1, "current"), ("q3", 1, "unchecked")}
    assert set(one(review.structure_changes(e), "question_id", "exports", "changes")) == {("q1", 2, 1), ("q2", 1, 0), ("q3", 1, 0)}
    out = spark.createDataFrame([("p", day(k), "pass" if k != 3 else "fail", f"s{k % 10}") for k in range(1, 13)], "profile_id string, at timestamp, verdict string, signature string")
    assert one(review.last_signatures(out), "signatures") == [([f"s{k}" for k in (5, 6, 7, 8, 9, 0, 1, 2)],)]


def test_pages_to_transcribe(spark):
    long = "The wall of the lobe is covered by the membrane, which joins the sheath of it."
    rows = [("d", 1, long, "pending_vision", "/a.png"), ("d", 2, None, "pending_vision", " "), ("d", 3, "abc", "pdf_text", "/b.JPG"), ("d", 4, f"{long}\n\nother\n\n{long}", "pdf_text", None)]
    p = spark.createDataFrame(rows, "document_id string, page int, text string, extraction_method string, rendered_image_path string")
    assert one(review.pending_pages(p), "page") == [(1,)] and one(review.pending_pages(p, True), "page") == [(1,), (3,)]
    assert set(one(review.transcription_outcome(p), "page", "outcome", "outcome_reason")) == {(1, "clean", None), (2, "garbled", "empty_extraction"), (3, "garbled", "too_short"), (4, "repeated", "repeated_content:0_1")}
    assert one(p.select(review.media_type(F.col("rendered_image_path")).alias("m")), "m") == [("image/png",), ("image/png",), ("image/jpeg",), ("image/png",)]
    q = spark.createDataFrame([("q", "d", [([3, 4],)]), ("r", "d", []), ("s", "e", None)], "question_id string, document_id string, source_spans array<struct<pages:array<int>>>")
    assert set(one(review.question_images(q, p), "question_id", "page", "image")) == {("q", 3, "/b.JPG"), ("r", None, None), ("s", None, None)}
    ls = spark.createDataFrame([("d", 1, k, f"line {k} " + "x" * (300 if k == 5 else 0)) for k in range(10)], "document_id string, page int, idx int, text string")
    marks = spark.createDataFrame([("d", 1, 1), ("d", 1, 4)], "document_id string, page int, idx int")
    got = one(review.excerpt_lines(ls, marks, 1, 500), "idx", "line")
    assert [k for k, _ in got] == [0, 1, 2, 3, 4, 5] and got[1] == (1, "p1:1| line 1 ") and got[5][1].endswith("…")
    assert len(one(review.excerpt_lines(ls, marks, 1, 40), "idx")) == 2


def test_streams(spark, tmp_path):
    from scriptoria.streaming import ingest

    source = tmp_path / "in"
    spark.createDataFrame([("k", i * 1_000_000, 2) for i in range(5)], "key string, time_us bigint, amount bigint").coalesce(1).write.parquet(str(source))
    schema = spark.read.parquet(str(source)).schema
    for _ in range(2):
        ingest.ingest_stream(spark.readStream.schema(schema).parquet(str(source)), str(tmp_path / "store"), str(tmp_path / "ck"), lambda b: b).awaitTermination()
    assert ingest.committed(spark, str(tmp_path / "store"), "key string, time_us bigint, amount bigint").count() == 5
    q = ingest.leaky_stream(spark.readStream.schema(schema).parquet(str(source)), 60, 60).writeStream.format("memory").queryName("levels").outputMode("append").option("checkpointLocation", str(tmp_path / "ck2")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.level for r in spark.table("levels").collect()) == [2_000_000, 3_000_000, 4_000_000, 5_000_000, 6_000_000]


def test_documents_with_their_pages(spark, tmp_path):
    page = "document_id string, page int, text string, extraction_method string, confidence double, is_garbled boolean, garbled_reason string, char_count int"
    pages = spark.createDataFrame([("d", 2, "b", "m", 0.9, False, None, 1), ("d", 1, "a", "m", 0.9, False, None, 1), ("d", 1, "a", "m", 0.9, False, None, 1)], page)
    documents = spark.createDataFrame([("d", "f.pdf"), ("d", "f.pdf"), ("e", "g.pdf")], "document_id string, original_filename string")
    out = files.nested_documents(pages, documents)
    files.write_json(out, str(tmp_path / "docs"), buckets=4)
    back = files.read_json(spark, str(tmp_path / "docs/*"), "document_id string, pages array<struct<page:int,text:string>>")
    assert {r.document_id: [tuple(x) for x in r.pages or []] for r in back.collect()} == {"d": [(1, "a"), (2, "b")], "e": []}


def test_counts_in_windows(spark):
    from scriptoria.streaming.ingest import windowed_counts

    rows = spark.createDataFrame([(day(1, 1), "a"), (day(1, 2), "a"), (day(2), "a"), (day(2), None)], "ts timestamp, kind string")
    assert {(r.window_start.day, r.kind, r.n) for r in windowed_counts(rows, "ts", "kind").collect()} == {(1, "a", 2), (2, "a", 1), (2, None, 1)}


def test_the_core_stands_alone():
    import ast
    from pathlib import Path

    root = Path(lines.__file__).resolve().parents[1]
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else []
                assert not any("scriptoria.llm" in n for n in names), path
