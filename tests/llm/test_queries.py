"""Registered queries: against their SQL, and against brute force where there is none."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF, same
from pyspark.sql import functions as F

from loomline.llm import near_dedup, packing
from loomline.llm._common import lower_words
from loomline.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert same(QUERIES[name](spark, SF).collect(), SQL[name])


def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_near_dedup_classes_are_the_components_of_exact_links(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frequencies = near_dedup.shingle_frequencies(docs)
    sets = {d: near_dedup.weighted_shingles(lower_words([r.text])[0], frequencies, 5) for d, r in documents(spark).items()}
    head = {d: d for d in sets}

    def top(x):
        while head[x] != x:
            x = head[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            if near_dedup.weighted_jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((top(a), top(b)))
                head[y] = x
    got = {r.doc_id: r.class_id for r in QUERIES["op1_near_dedup"](spark, SF).collect()}
    assert got == {d: top(d) for d in sets}
    assert len(set(got.values())) < len(got)


def test_pii_base_spans(spark):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def luhn(d):
        return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0

    def spans(text):
        out = []
        for no, (kind, p) in enumerate(patterns.items()):
            for m in re.finditer(p, text):
                d = re.sub("[^0-9]", "", m[0])
                good = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")), "card": lambda: 14 <= len(d) <= 19 and luhn(d), "phone": lambda: 10 <= len(d) <= 15}  # noqa: B023
                if good[kind]():
                    out.append((m.start(), no, m.end(), kind))
        return sorted(out)

    want = {d: spans(r.text) for d, r in documents(spark).items()}
    for r in QUERIES["op3_pii"](spark, SF).collect():
        base = want[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in base) for k in patterns]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in base).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for a, _, b, k in base} <= set(r.spans.split(","))


def test_token_counts_equal_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    want = {d: len(t.encode(r.text, add_special_tokens=False).ids) for d, r in documents(spark).items()}
    got = QUERIES["op6_token_counts"](spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and all(r.closed for r in got)


def test_decontamination_finds_verbatim_items(spark):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r for r in QUERIES["op7_decontamination"](spark, SF).collect()}
    verbatim = {(d, i) for d, r in documents(spark).items() for i, x in items.items() if x in r.text}
    assert verbatim <= set(got) and all(got[k].distance == 0 for k in verbatim)


def test_language_is_learned(spark):
    docs = documents(spark)
    got = QUERIES["op8_language_id"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.95 * len(held)


def test_packing_holds_each_id_once(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = documents(spark)
    ids = {d: np.array([*t.encode(r.text, add_special_tokens=False).ids, 2], "<u4") for d, r in docs.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in QUERIES["op10_packing"](spark, SF).collect():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        assert _gapless(pieces) == len(ids[d])
    sizes = [_gapless(p) for p in by_sequence.values()]
    assert max(sizes) <= 4096
    assert all(s & (s - 1) == 0 for s in sizes), "every sequence has a power-of-two length: no padding"


def _gapless(pieces):
    at = 0
    for start, length in sorted(pieces):
        assert start == at
        at += length
    return at


def test_packer_cuts_little():
    rng = np.random.default_rng(1)
    p = packing.Packer()
    for i, n in enumerate(rng.integers(1, 3000, 2000)):
        p.add(i, int(n))
    p.pack()
    pieces = sum(len(w) for _, w in p.windows)
    assert sum(x[0] for x in p.pool) < 4096 and pieces < 2000 * 1.35
    assert all(sum(x[2] for x in w) == size for size, w in p.windows)
    dealt = packing.step_groups([s for s, _ in p.windows], 1 << 16)
    loads = np.bincount(dealt, weights=[s for s, _ in p.windows])
    assert loads.max() - loads.min() <= 3 * 4096


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    at, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, SF)
        if name != "packing":
            assert out.columns == docs.columns
        rows = out.collect()
        at, seen[name] = spark.createDataFrame(rows, out.schema), rows
    classes = {r.doc_id: r.class_id for r in QUERIES["op1_near_dedup"](spark, SF).collect()}
    assert {r.doc_id for r in seen["near_dedup"]} == {d for d, c in classes.items() if d == c}
    assert not any(x in r.text for r in seen["decontamination"] for x in items)
    assert len(seen["pii"]) == len(seen["decontamination"])
    assert not any(re.search(r"[a-z]@[a-z0-9]+\.[a-z]", r.text) for r in seen["pii"])
    assert all(r.n_chars == len(r.text) for r in seen["pii"])
    assert {r.doc_id for r in seen["packing"]} == {r.doc_id for r in seen["pii"]}


def test_pipeline_equals_plain_models(spark):
    """The documents that come through are those that plain models of each stage keep."""
    import corpus_pipeline
    from loomline.llm import decontamination, language_id, pii

    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {d: r.text for d, r in documents(spark).items()}
    model = language_id.train(table.filter(~language_id.held_out()))
    names, scores = model.predict(list(docs.values()))
    docs = {d: t for (d, t), n, s in zip(docs.items(), names, scores, strict=True) if n != "und" and s >= 0.5}
    frequencies = near_dedup.shingle_frequencies(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))
    sets = {d: near_dedup.weighted_shingles(lower_words([t])[0], frequencies, 5) for d, t in docs.items()}
    head = {d: d for d in docs}

    def top(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in sorted(docs):
        for b in sorted(docs):
            if b < a and near_dedup.weighted_jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((top(a), top(b)))
                head[y] = x
    docs = {d: t for d, t in docs.items() if top(d) == d}
    plan, items = decontamination.Plan(), [decontamination.normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = lambda t: any(decontamination.edit_distance_within(x, t)[0] <= decontamination.allowed(len(x), plan) for x in items)
    docs = {d: t for d, t in docs.items() if not holds(decontamination.normalised(t))}
    spans = {r.doc_id: r.spans for r in pii.detect(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    for d, t in docs.items():
        out, at = "", 0
        for s in spans[d]:
            if s.start >= at:
                out += t[at : s.start] + f"[{s.kind.upper()}]"
            at = max(at, s.stop)
        docs[d] = out + t[at:]
    got = defaultdict(int)
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] += r.length
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert dict(got) == {d: len(t.encode(x, add_special_tokens=False).ids) + 1 for d, x in docs.items()}


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls, repeats, long and empty texts and clashing columns pass every stage; an empty table gives no row."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").orderBy("doc_id").limit(60).collect()
    long = " ".join(r.text for r in docs[:40]) * 3
    odd = [(1000, None, "en"), (1001, "", "en"), (None, docs[3].text, "en"), (1003, "?! 12", None), (1004, long, None), (docs[5].doc_id, docs[5].text, docs[5].lang)]
    rows = [(r.doc_id, r.text, r.lang, "x", "y", 5) for r in docs] + [(*r, "x", "y", 5) for r in odd]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, spans string, node string, is_clean int")
    for folder, table in (("some", df), ("none", df.limit(0))):
        table.write.parquet(f"{tmp_path}/{folder}/documents.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/{folder}/benchmark.parquet")
    at = spark.read.parquet(f"{tmp_path}/some/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, f"{tmp_path}/some")
        assert at.columns == df.columns, name
        at.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
    ids = [r.doc_id for r in at.collect()]
    assert 1000 not in ids and 1001 not in ids and 1003 not in ids and None in ids and ids.count(docs[5].doc_id) <= 1
    assert corpus_pipeline.run(spark, f"{tmp_path}/some").count() > 0 and corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
