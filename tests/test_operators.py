"""Operators against small serial models and edge cases."""

import json
import os
import random
import shutil

import pytest
from conftest import same
from pyspark.sql import functions as F

from loomline.functions.text import last_boxed, prose_parts, think_parts
from loomline.operators import dedup, mix, normalize, quality, reasoning, split, validate
from loomline.sources import io
from loomline.sources.catalog import Source, as_table, available


def one(spark, value, *columns):
    return tuple(spark.createDataFrame([(value,)], "x string").select(*[c(F.col("x")) for c in columns]).first())


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("<think>a</think> b", ("a", "b")), ("<THINK></think>b", (None, "b")), ("<think>a</think>", ("a", "<think>a</think>")), ("<think>p1\n\np2", ("p1", "p2")),
        ("<think>p", ("p", "p")), ("<think>", (None, "")), ("x", (None, "x")), (None, (None, "")), ("pre <think>a</think> b <think>c</think>", ("a", "b <think>c</think>")),
        (" x ", (None, "x")), ("<think>a\n\n \n\nb\n\nc", ("a\n\nb", "c")),
    ],
)
def test_split_think(spark, text, want):
    assert one(spark, text, lambda c: think_parts(c)["reasoning"], lambda c: think_parts(c)["answer"]) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [(r"\boxed{a{b}c}", "a{b}c"), (r"\boxed{1} \boxed{2}", "2"), (r"\boxed{a", None), (r"\boxed{ }", None), ("none", None), (r"\boxed{1} \boxed{2", None), (r"\boxed{{{x}}}}", "{{x}}"), (None, None)],
)
def test_last_boxed(spark, text, want):
    assert one(spark, text, last_boxed) == (want,)


@pytest.mark.parametrize(
    ("text", "expected", "want"),
    [("w", "Proof", (None, "w")), ("w", "7", ("w", r"The final answer is $\boxed{7}$.")), ("a\n\nb", None, ("a", "b")), (r"w \boxed{3}", "n/a", (r"w \boxed{3}", r"The final answer is $\boxed{3}$.")), ("", "7", (None, ""))],
)
def test_split_prose(spark, text, expected, want):
    df = spark.createDataFrame([(text, expected)], "x string, e string")
    assert tuple(df.select(prose_parts(F.col("x"), F.col("e")).alias("p")).select("p.*").first()) == want


def test_adapters_roles_and_guard(spark):
    rows = [(0, "", [("Human", "q"), ("critic", "x"), ("GPT", "<think>t</think> a"), ("tool", " ")], "CODE"), (1, "n", [("user", " "), ("gpt", "a")], None), (2, None, [("user", "q"), ("gpt", " ")], "x"), (3, None, None, None)]
    df = spark.createDataFrame(rows, "idx long, id string, conversations array<struct<`from`:string,value:string>>, domain string")
    got = normalize.records(df, Source("s/x", "sharegpt", "tool", config="c", columns={"conversations": "conversations", "domain_field": "domain"})).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.name, r.domain, r.idx, r.reasoning_present) == ("s__x__c", "code", 0, True)
    assert [(m.role, m.content, m.reasoning) for m in r.messages] == [("user", "q", None), ("assistant", "a", "t")]


def test_instruct_rates_and_missing_columns(spark):
    df = spark.createDataFrame([(0, "p", "work", "9", "0.25"), (1, "p2", "w2", None, "bad")], "idx long, problem string, out string, answer string, rate string")
    s = Source("s", "instruct", "math", prose=True, columns={"instruction": "problem", "output": "out", "answer": "answer", "pass_rate": "rate", "more": "gone"})
    got = {r.idx: r for r in normalize.records(df, s).collect()}
    assert got[0].meta.pass_rate == 0.25 and got[0].messages[1].reasoning == "work" and got[0].meta.expected_answer == "9"
    assert got[1].meta.pass_rate is None and got[1].messages[1].reasoning is None


def test_quality_bounds(spark):
    def kept(content, domain="chat", reasoning=None):
        df = spark.createDataFrame([([("user", "q", None), ("assistant", content, reasoning)], domain)], f"messages {normalize.MESSAGES}, domain string")
        return quality.quality_filter(df, max_chars=20).count() == 1

    assert kept("x" * 20) and not kept("x" * 21) and not kept("x" * 11, reasoning="y" * 10)
    assert kept("�" * 3) and not kept("�" * 4)
    assert not kept("```", "code") and kept("```") and kept("a", "code", "```") and not kept("  ")


def odd_documents(spark, folder):
    """Copies in other letters, short texts, blanks, empty and missing texts, and a text of one shingle again and again."""
    texts = ["One two three four five six", "one TWO three four five six", "Ab cd", "aB cD", " ", "", None, "?!", "x " * 5000, "Ünï ß x y z w", " ".join(map(str, range(9000)))]
    rows = [(i, t, "en", f"src{i % 9}", len(t or "")) for i, t in enumerate(texts * 2)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"file://{folder}/new")
    os.rename(next((folder / "new").glob("*.parquet")), folder / "documents.parquet")
    shutil.rmtree(folder / "new")
    return str(folder)


def test_shingle_stats_moves_no_text(spark, tmp_path):
    from loomline.plans.catalog import QUERIES, SQL

    df = QUERIES["shingle_stats"](spark, odd_documents(spark, tmp_path))
    assert same(df.collect(), SQL["shingle_stats"], str(tmp_path))
    # shingles are never rows, and the text ends below the first sort
    plan = df._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.split("\n") if "Generate" in line or "Window [" in line]
    assert sorts and not any("Generate" in line or "body" in line for line in sorts)


def test_minima_in_pieces():
    import pyarrow as pa

    rng = random.Random(7)
    family = dedup.permutations(6)
    lists = [[rng.randrange(dedup.PRIME) for _ in range(n)] for n in (3, 0, 1, 40, 8, 8, 0, 5)] + [None, [0, dedup.PRIME - 1], []]
    want = [[min((a * x + b) % dedup.PRIME for x in v) for a, b in family] if v else None for v in lists]
    for piece in (1, 2, 7, 8, 16, 1 << 16):
        assert dedup.minima(pa.array(lists, pa.list_(pa.int32())), family, piece).to_pylist() == want
    assert dedup.minima(pa.array([[], None], pa.list_(pa.int32())), family).to_pylist() == [None, None]


def test_memory_of_minima_is_that_of_a_piece():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    def most(texts):
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, texts + 1, dtype=np.int32) * 20000), pa.array(np.arange(texts * 20000, dtype=np.int32)))
        tracemalloc.start()
        dedup.minima(lists, dedup.permutations(2))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return peak

    assert most(200) < 1.2 * most(20) < 4e6


@pytest.mark.parametrize("name", ["minhash_signatures", "lsh_partners", "near_dedup_keep", "dedup_report"])
def test_signatures_of_odd_texts(spark, tmp_path, name):
    from loomline.plans.catalog import QUERIES, SQL

    assert same(QUERIES[name](spark, odd_documents(spark, tmp_path)).collect(), SQL[name], str(tmp_path))


def test_signing_moves_no_text(spark):
    df = spark.createDataFrame([("a b c d e f", 1), ("A b c d e f", 2), ("x", 3), ("", 4)], "t string, i int")
    signed = dedup.signed_firsts(df, F.col("t"), ["i"], "s")
    plan = signed._jdf.queryExecution().executedPlan().toString().split("\n")
    made = next(i for i, line in enumerate(plan) if "ArrowEvalPython" in line)
    # the texts' signatures are made below the first exchange and the first sort
    assert made > max(i for i, line in enumerate(plan) if "Exchange" in line or "Sort [" in line)
    assert [(r.i, r.s is None) for r in sorted(signed.collect(), key=lambda r: r.i)] == [(1, False), (3, False), (4, True)]


def serial_keep(edges, n):
    kept = []
    for i in range(n):
        if not any((j, i) in edges for j in kept):
            kept.append(i)
    return set(kept)


def test_keep_first_equals_serial_pass(spark):
    rng = random.Random(4)
    for _ in range(4):
        members = {(rng.randrange(15), rng.randrange(25)) for _ in range(45)}
        edges = {(a, b) for k, a in members for m, b in members if k == m and a < b}
        df = spark.createDataFrame([(f"b{k}", v) for k, v in members], "bucket string, node int")
        gone = {r.node for r in dedup.keep_first(df).collect()}
        assert set(range(25)) - gone == serial_keep(edges, 25)


def test_keep_first_chain(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 2), ("y", 3)], "bucket string, node int")
    assert {r.node for r in dedup.keep_first(df).collect()} == {2}


def serial_sample(rows, target):
    out, total, n = [], 0, 0
    while rows and target > 0 and total < target and n < 3:
        for name, tokens in rows:
            if total >= target:
                break
            out.append((name, n))
            total += tokens
        n += 1
    return out


@pytest.mark.parametrize("target", [0, 1, 25, 60, 1000])
@pytest.mark.parametrize("zero", [False, True])
def test_budget_sample_equals_serial_loop(spark, target, zero):
    rng = random.Random(target)
    rows = [(f"{rng.getrandbits(64):016x}", "d", 0 if zero else rng.randint(0, 9)) for _ in range(12)]
    pool = spark.createDataFrame(rows, "k string, g string, tokens long")
    got = mix.budget_sample(pool, spark.createDataFrame([("d", float(target))], "g string, target double"), "g", "k")
    assert {(r.k, r["pass"]) for r in got.collect()} == set(serial_sample(sorted((k, t) for k, _, t in rows), target))


def test_taken_in_order_overshoots_by_one(spark):
    df = spark.createDataFrame([(i, 10) for i in range(20)], "i int, tokens long")
    got, total = mix.taken_in_order(df, ["i"], 5, 38)
    assert sorted(r.i for r in got.collect()) == [0, 1, 2, 3] and total == 40


def test_split_keeps_copies_together(spark):
    df = spark.createDataFrame([(f"k{i % 30}",) for i in range(90)], "k string")
    got = split.train_test(df, "k", share=0.1).groupBy("side").agg(F.count("*").alias("n"), F.countDistinct("k").alias("u")).collect()
    assert {(r.side, r.n, r.u) for r in got} == {("test", 3, 3), ("train", 81, 27)}
    single = split.train_test(spark.createDataFrame([("a",)] * 3, "k string"), "k").collect()
    assert [r.side for r in single] == ["test"]
    assert split.train_test(df.limit(0), "k").count() == 0


def test_guards(spark):
    empty = spark.createDataFrame([], "c array<string>")
    with pytest.raises(ValueError):
        split.require_rows(empty, "c")
    rows = lambda n: spark.createDataFrame([([],)] * n + [(["x"],)] * (10 - n), "c array<string>")
    split.require_rows(rows(8), "c")
    with pytest.raises(ValueError):
        split.require_rows(rows(9), "c")


def test_reasoning_gate_and_clip(spark):
    sources = [Source("a", "limo", "math"), Source("b", "messages", "chat", gated=True)]
    rows = spark.createDataFrame([("a", True), ("a", False), ("a", False), ("b", False)], "name string, reasoning_present boolean")
    with pytest.raises(ValueError, match="a 33%"):
        reasoning.require_reasoning(rows, as_table(spark, sources))
    reasoning.require_reasoning(rows.filter("name = 'b' OR reasoning_present"), as_table(spark, sources))
    assert [s.id for s in available(sources)] == ["a"]
    clip = lambda c: reasoning.clip(c, 6)
    assert one(spark, "abc def", clip) == ("abc",) and one(spark, "abcdefgh", clip) == ("abcdef",) and one(spark, "ab cd", clip) == ("ab cd",)


def test_gates_and_card():
    g = validate.Gates()
    g.add("decontam", True, critical=True)
    g.add("shares", False)
    assert g.passed
    g.add("objects", False, critical=True)
    assert not g.passed
    text = validate.card("t", 1, [{"id": "x/y", "name": "x__y", "license": "check-card"}], {"b": 3}, 9, [{"stage": "s", "n_rows": 2, "unique_rows": 1, "tokens": 5}], [])
    assert "| licences to check | x__y |" in text and "| s | 2 | 1 | 5 |" in text


def test_json_lines_number_physical_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n{"x": 3}\n')
    got = io.read_json_lines(spark, f"file://{tmp_path}/a.jsonl", "x int").collect()
    assert sorted((r.idx, r.x) for r in got) == [(0, 1), (2, 3)]
    n = io.write_json_array(spark.createDataFrame([(1, None), (2, "é")], "a int, b string").coalesce(1), f"file://{tmp_path}/out.json")
    assert n == 2 and json.loads((tmp_path / "out.json").read_text()) == [{"a": 1, "b": None}, {"a": 2, "b": "é"}]
    assert io.write_json_array(spark.range(0), f"file://{tmp_path}/none.json") == 0 and json.loads((tmp_path / "none.json").read_text()) == []
    assert io.signed_seconds(10**9) == io.MAX_SIGNED and io.row_cap(5, {"LOOMLINE_SMOKE_ROWS": "3"}) == 3 and io.row_cap(0, {}) is None
    bad = spark.range(3).select(F.expr("raise_error('late')").alias("x"))
    for read, name in ((lambda: 1 / 0, "ZeroDivisionError"), (lambda: bad, "late")):
        df, state = io.acquire(read, f"file://{tmp_path}/raw", wait=0)
        assert df is None and state["status"] == "unavailable" and name in state["error"]
    df, state = io.acquire(lambda: spark.range(5), f"file://{tmp_path}/raw")
    assert df.count() == state["retained"] == 5 and state["columns"] == ["id"]


def test_json_lines_of_many_splits(spark, tmp_path):
    """Line numbers hold across the splits of a file."""
    (tmp_path / "b.jsonl").write_text("".join("\n" if i % 7 == 3 else f'{{"x": {i}}}\n' for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = io.read_json_lines(spark, f"file://{tmp_path}/b.jsonl", "x int").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.idx, r.x) for r in got) == [(i, i) for i in range(4000) if i % 7 != 3]


def test_first_rows_by_ranges_and_store(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(f"g{i % 3}", i) for i in range(300)], "g string, i int")
    small = {(r.g, r.i) for r in io.first_rows(df, 20, "g", "i").collect()}
    monkeypatch.setattr(io, "PRUNED_ROWS", 1)
    assert {(r.g, r.i) for r in io.first_rows(df, 20, "g", "i").collect()} == small and len(small) == 60
    (tmp_path / "up/a").mkdir(parents=True)
    (tmp_path / "up/a/x.txt").write_text("1")
    (tmp_path / "up/y.txt").write_text("22")
    store = io.ensure_folder(spark, f"file://{tmp_path}/store")
    assert io.sync_up(spark, str(tmp_path / "up"), store) == ["a/x.txt", "y.txt"] and io.sync_up(spark, str(tmp_path / "up"), store) == []
    assert [k for k in io.list_keys(spark, store) if not k.startswith(".") and "/." not in k] == ["a/x.txt", "y.txt"] and io.list_keys(spark, f"{store}/none") == []
    io.download_file(spark, f"{store}/y.txt", str(tmp_path / "back.txt"))
    assert (tmp_path / "back.txt").read_text() == "22"


def test_tokens_of_a_tokenizer(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from loomline.operators.tokens import token_count

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["a few words", None, "", "it's 2024"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    known = Tokenizer.from_file(path)
    assert {r.i: r.n for r in df.select("i", token_count(F.col("t"), path).alias("n")).collect()} == {i: len(known.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_short_questions(spark):
    """Questions of one or two tokens, also of one or two characters, are found as substrings."""
    from loomline.operators import decontam

    docs = spark.createDataFrame([(1, "the cat sat"), (2, "Concatenate this"), (3, "x y"), (4, None), (5, "a long enough question of many words stands here")], "i int, t string")
    ask = lambda *q: sorted(r.i for r in decontam.holding(docs, F.col("t"), spark.createDataFrame([(x,) for x in q], "text string")).collect())
    assert ask("cat") == [1, 2] and ask("e cat") == [1] and ask("y") == [3, 5] and ask("", "!") == []
    assert ask("enough question of many words", "x Y") == [3, 5]


def test_catalog_and_mirrors(spark, tmp_path):
    from loomline.sources.catalog import BENCHMARKS, SOURCES

    assert len(SOURCES) == 21 and len({s.name for s in SOURCES}) == 21 and sum(s.must_reason for s in SOURCES) == 7
    assert SOURCES[0].name == "nvidia__OpenMathReasoning__default__cot" and len(available(SOURCES)) == 17
    (tmp_path / "gsm8k").mkdir()
    (tmp_path / "gsm8k/data.jsonl").write_text('{"question": "q"}\n{"question": ""}\n')
    rows, status = io.read_benchmarks(spark, f"file://{tmp_path}", ["gsm8k", "aime", "other"], BENCHMARKS)
    assert rows.count() == 1 and status["gsm8k"] == 1 and status["aime"].startswith("ERR:") and status["other"] == "no-loader"
    df = spark.createDataFrame([("s", 0, "train", "a"), ("s", 1, "test", "b")], "stage string, chunk long, side string, v string")
    io.write_chunks(df, f"file://{tmp_path}/chunks")
    assert spark.read.json(f"file://{tmp_path}/chunks/stage=s/chunk=1/side=test").first().v == "b"


def test_tokenizer_round_trip():
    enc, dec = (lambda s: list(s.encode())), (lambda b: bytes(b).decode())
    assert validate.round_trip(enc, dec, ["é x"], ("ab",)) == {"sample 0": True, "tag ab": True}
    assert not validate.round_trip(enc, dec, [], ("<think>",))["tag <think>"]
