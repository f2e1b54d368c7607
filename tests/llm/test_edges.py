"""Nulls, empty and very long texts, repeats, empty tables and clashing names."""

import random

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from loomline.llm import decontamination, language_id, near_dedup, packing, pii, quality_rules, substring_dedup, token_counts, url_filters, warc
from loomline.llm._common import fresh, shared_dir, span_hashes, written
from loomline.llm.components import components, joined_further
from loomline.llm.tokens import WordTokenizer, default_path

WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


LONG = prose(60_000, 0)
ODD = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t", None), (None, prose(60, 1), "en"), (4, prose(60, 1), "en"), (5, prose(60, 1), "de"), (5, prose(60, 1), "de"),
    (6, LONG, "de"), (7, "!!! ???", "en"), (8, "é" * 10 + " \U0001f600 " + prose(80, 2), "fr"), (9, "a", "fr"), (10, "1" * 5000, None),
]
SCHEMA = "doc_id long, text string, lang string, spans string, kept string, row long, path string, node string, n_words long, host string"


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with every oddity, and columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "s", "k", 7, "p", "n", 3, "h") for r in ODD], SCHEMA)


def test_language(spark, odd):
    model = language_id.train(odd)
    got = language_id.identify(odd, model).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (1, 2, 3, 7, 10))
    assert by[6].lang_pred == "de" and set(odd.columns) < set(got[0].asDict())
    assert language_id.keep_identified(odd, model).columns == odd.columns
    nothing = language_id.train(odd.filter("false"))
    assert {r.lang_pred for r in language_id.identify(odd, nothing).collect()} == {"und"}
    assert language_id.identify(odd.limit(0), model).count() == 0
    # a text longer than a block scores as its parts together
    pieces = language_id.LanguageModel(("x", "y"), np.random.default_rng(0).normal(size=(1 << 15, 2)).astype("f4"), np.zeros(2), 15)
    assert pieces.predict([LONG * 5])[0] in (["x"], ["y"])


def test_language_depends_on_the_text_alone(spark):
    """Scores are equal however rows are dealt and ordered, and the language is that of the plain model."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.train(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(-1, "zzz"), (-2, ""), (-3, None), (-4, "a")]
    one = dict(zip([i for i, _ in rows], zip(*model.predict([t for _, t in rows]), strict=True), strict=True))
    random.Random(1).shuffle(rows)
    two = dict(zip([i for i, _ in rows], zip(*model.predict([t for _, t in rows]), strict=True), strict=True))
    alone = {i: tuple(x[0] for x in model.predict([t])) for i, t in rows[:60]}
    assert one == two and all(one[i] == a for i, a in alone.items())
    again = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs.repartition(3, "text"), model).collect()}
    assert all(one[i] == v for i, v in again.items())
    table = language_id.letter_table()
    for i, text in rows[:60]:
        if any(c.isalpha() for c in text or ""):
            low = [32, 32, *(int(table[ord(c)]) for c in text), 32, 32]
            total = model.prior.copy()
            for order in language_id.ORDERS:
                for at in range(2, len(low)):
                    total += model.log_prob[language_id.ngram_buckets(np.array(low[at - order + 1 : at + 1], np.uint32), order, model.bits)[-1]]
            assert one[i][0] == model.languages[int(total.argmax())]


def test_near_dedup(spark, odd):
    got = {(r.id, r.class_id) for r in near_dedup.classes(odd).collect()}
    assert got == {(None, None), (1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (7, 7), (8, 8), (9, 9), (10, 10)}
    kept = near_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, i) for i in (1, 2, 3, 4, 6, 7, 8, 9, 10)] + [(True, 0)]
    assert near_dedup.classes(odd.limit(0)).count() == 0 and near_dedup.keep_first(odd.limit(0)).count() == 0
    twice = spark.createDataFrame([(5, "same words here now again", "x"), (5, "same words here now again", "x")], "doc_id long, text string, lang string")
    assert near_dedup.keep_first(twice).count() == 1


def test_near_dedup_group_of_edits(spark):
    """A large group of edits of one text: the links of the plain model are all found."""
    base, rng = prose(150, 9).split(), random.Random(3)
    rows = [(0, " ".join(base))]
    for i in range(1, 160):
        w = list(base)
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(len(w))] = f"x{i}y{rng.randrange(99)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    frequencies = near_dedup.shingle_frequencies(docs)
    sets = [near_dedup.weighted_shingles(near_dedup.lower_words([t])[0], frequencies, 5) for _, t in rows]
    links = [(a, b) for a in range(160) for b in range(a) if near_dedup.weighted_jaccard(sets[a], sets[b]) >= 0.8]
    got = {r.id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert links and all(got[a] == got[b] for a, b in links)
    linked = {x for pair in links for x in pair}
    assert all(got[i] == i for i in range(160) if i not in linked)


def test_near_dedup_alike_but_apart_makes_few_pairs(spark, monkeypatch):
    """Texts with a long part in common and an end of their own, nearly all under the threshold: no link is lost, few pairs are made."""
    common, n = prose(150, 9), 120
    rows = [(i, f"{common} " + " ".join(f"x{i}y{k}" for k in range(14))) for i in range(n)]
    rows += [(n + i, rows[i][1] + " end") for i in range(0, n, 40)]
    n = len(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    frequencies = near_dedup.shingle_frequencies(docs)
    sets = [near_dedup.weighted_shingles(near_dedup.lower_words([t])[0], frequencies, 5) for _, t in rows]
    links = [(a, b) for a in range(n) for b in range(a) if near_dedup.weighted_jaccard(sets[a], sets[b]) >= 0.8]
    made, verify = [], near_dedup._verified

    def counted(pairs, *rest):
        made.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(near_dedup, "_verified", counted)
    got = {r.id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert links and all(got[a] == got[b] for a, b in links)
    linked = {x for pair in links for x in pair}
    assert all(got[i] == i for i in range(n) if i not in linked)
    assert len(made) == 2 and made[1] <= n, made


def test_pipeline_stage_alike_but_apart(spark, monkeypatch):
    """The stage keeps all texts that are alike but under the threshold, drops later ones of links, and makes few pairs."""
    import corpus_pipeline

    common, n = prose(150, 9), 60
    rows = [(i, f"{common} " + " ".join(f"x{i}y{k}" for k in range(14)), 7) for i in range(n)]
    rows += [(n + i, rows[i][1] + " end", 7) for i in range(0, n, 20)]
    made, verify = [], near_dedup._verified

    def counted(pairs, *rest):
        made.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(near_dedup, "_verified", counted)
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, n_chars int"), "")
    assert kept.columns == ["doc_id", "text", "n_chars"] and sorted(r.doc_id for r in kept.collect()) == list(range(n))
    assert len(made) == 2 and made[1] <= len(rows), made


def test_profiles_bound_the_common_weight(spark):
    """For sets that share much or little, short and long, with as many groups or twice as many."""
    rng, rows = np.random.default_rng(2), []
    for size in (1, 3, 40, 63, 64, 65, 200, 520, 3000, 9000):
        for share in (0.0, 0.5, 0.9, 1.0):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[: int(size * share)], rng.integers(0, 1 << 63, size - int(size * share), dtype=np.uint64)]))
            x, y = (a, rng.uniform(1, 2, len(a)).astype("f4")), (b, rng.uniform(1, 2, len(b)).astype("f4"))
            y = (y[0], (y[1] * (x[1].sum() / y[1].sum() * rng.uniform(0.81, 1.24))).astype("f4"))
            common = np.intersect1d(a, b, return_indices=True)
            rows.append(([float(v) for v in near_dedup.profile(*x)], [float(v) for v in near_dedup.profile(*y)], float(np.minimum(x[1][common[1]], y[1][common[2]]).sum(dtype="f8")), float(x[1].sum())))
    assert {len(a) / len(b) for a, b, *_ in rows} == {0.5, 1.0, 2.0}
    table = spark.createDataFrame(rows, "a array<float>, b array<float>, common double, weight double")
    got = table.withColumn("most", F.expr(near_dedup._common_at_most("a", "b"))).collect()
    assert len(got) == len(rows) and all(r.common <= r.most * (1 + 1e-6) for r in got)
    # texts of up to some thousand shingles that have nothing in common are told apart
    assert all(r.most < 0.8 * r.weight for r in got if not r.common and 64 <= r.weight < 3000)


def test_sampling_estimates_weighted_similarity():
    rng = np.random.default_rng(5)
    s = near_dedup.Sampler(4000, 1)
    common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (400, 60, 90))
    w = rng.uniform(1, 4, 550).astype("f4")
    x = (np.concatenate([common, a]), np.concatenate([w[:400], w[400:460]]))
    y = (np.concatenate([common, b]), np.concatenate([w[:400] * 1.2, w[460:]]).astype("f4"))
    order = lambda z: (z[0][np.argsort(z[0])], z[1][np.argsort(z[0])])
    true = near_dedup.weighted_jaccard(order(x), order(y))
    first = np.array([0])
    assert abs((s(*x, first) == s(*y, first)).mean() - true) < 0.03


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 102), (102, 101), (100, 100)]
    got = {(r.node, r.component) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(1, 31)} | {(101, 100), (102, 100)}


@pytest.fixture
def many_parts(spark):
    """Shuffles of 23 parts that are not put together, as in a large job."""
    conf = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield conf
    for k, v in before.items():
        spark.conf.set(k, v)


def parts_of(spark, kinds):
    """Part files of the tables of these kinds in the shared folder, by folder."""
    from pathlib import Path

    from loomline.functions.storage import _base

    return {d.name: len(list(d.glob("part-*"))) for d in Path(_base(spark).removeprefix("file://")).glob("*") if d.name.rpartition("-")[0] in kinds}


def test_components_of_few_links_write_few_files(spark, many_parts):
    kinds = {"links", "least", "components"}
    known = parts_of(spark, kinds)
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    least = list(range(400))
    for _ in range(400):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    want = {(i, c) for i, c in enumerate(least) if i != c}
    first, further = (spark.createDataFrame(x, "a long, b long") for x in (links[:200], links[200:]))
    got = [(r.node, r.component) for r in joined_further(components(first), further).collect()]
    assert len(got) == len(want) and set(got) == want
    made = {d: n for d, n in parts_of(spark, kinds).items() if d not in known}
    assert made and max(made.values()) == 1
    # links that are stars already need no round
    known |= made
    assert {(r.node, r.component) for r in components(spark.createDataFrame([(0, 3), (2, 0), (5, 4)], "a long, b long")).collect()} == {(2, 0), (3, 0), (5, 4)}
    assert len(parts_of(spark, kinds)) == len(known) + 1
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_dedup_writes_few_files_of_few_links(spark, many_parts):
    kinds = {"near-links", "links", "least", "components", "buckets", "pivots", "mixed"}
    known = parts_of(spark, kinds)
    rng = random.Random(12)
    rows = []
    for g in range(40):
        text = prose(160, 500 + g).split()
        for _ in range(3):
            edited = list(text)
            edited[rng.randrange(160)] = "edited"
            rows.append((len(rows), " ".join(edited)))
    got = {r.id: r.class_id for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(set(got.values())) < 60  # most texts are linked
    made = {d: n for d, n in parts_of(spark, kinds).items() if d not in known}
    assert {d.rpartition("-")[0] for d in made} >= {"near-links", "links", "buckets", "pivots"}
    assert max(made.values()) <= spark.sparkContext.defaultParallelism


def test_substring(spark, odd):
    shared = prose(40, 77)
    more = spark.createDataFrame([(20, f"{prose(10, 3)} {shared} {prose(5, 4)}", "x"), (21, f"{prose(3, 5)}\n{shared}", "x"), (22, "a " * 80, "x")], "doc_id long, text string, lang string")
    rows = odd.select("doc_id", "text", "lang").unionByName(more).withColumn("row", F.lit(1)).withColumn("kept", F.lit("x"))
    want = brute([r.text for r in rows.collect()])
    ids = [r.doc_id for r in rows.collect()]
    key = lambda t: (str(t[0]), *t[1:])
    for plan in (substring_dedup.Plan(), substring_dedup.Plan(hot=1, batch_words=50)):
        got = [(r.doc_id, r.n_words, r.n_removed, bytes(r.kept).decode()) for r in substring_dedup.remove_repeats(rows, plan=plan).collect()]
        assert sorted(got, key=key) == sorted(((i, *w) for i, w in zip(ids, want, strict=True)), key=key)
    assert substring_dedup.remove_repeats(odd.limit(0)).count() == 0


def brute(texts, k=35):
    words = [(t or "").encode().split() for t in texts]
    seen = {}
    for d, w in enumerate(words):
        for i in range(len(w) - k + 1):
            seen.setdefault(b" ".join(w[i : i + k]), []).append((d, i))
    gone = [set() for _ in words]
    for at in seen.values():
        if len(at) > 1:
            for d, i in at:
                gone[d].update(range(i, i + k))
    return [(len(w), len(g), b" ".join(x for i, x in enumerate(w) if i not in g).decode()) for w, g in zip(words, gone, strict=True)]


def test_repeated_starts_equals_counting():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 3, 400).astype(np.uint64)
    starts = np.arange(0, 390)
    for depth in (1, 2, 3, 5, 8, 10):
        keys = [tuple(words[i : i + depth]) for i in starts]
        assert substring_dedup.repeated_starts(words, starts, depth).tolist() == [keys.count(k) > 1 for k in keys]


def test_decontamination(spark, odd):
    passage = prose(30, 50)
    w = passage.split()
    edited = " ".join([*w[:7], "zzz", *w[8:20], *w[21:]])
    items = spark.createDataFrame([(1, passage), (2, None), (3, ""), (4, "??"), (1, passage)], "item_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(30, f"{prose(50, 6)} {passage.upper()}! {prose(9, 7)}"), (31, f"{prose(20, 8)} {edited}"), (32, " ".join(w[:10]))], "doc_id long, text string"))
    got = decontamination.contaminations(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(30, 1), (31, 1)}
    assert {r.distance for r in got if r.doc_id == 30} == {0}
    kept = decontamination.keep_clean(docs.withColumn("is_clean", F.lit("c")), items)
    assert kept.count() == docs.count() - 2 and kept.columns == ["doc_id", "text", "is_clean"]
    assert decontamination.contaminations(docs, items.limit(0)).count() == 0 == decontamination.contaminations(docs.limit(0), items).count()
    assert decontamination.keep_clean(docs, items.limit(0)).count() == docs.count()


def test_decontamination_recall():
    """Items within the threshold are found in 19 of 20 cases at least, however edited."""
    rng, plan = random.Random(8), decontamination.Plan()
    items = [(i, prose(rng.randint(15, 60), 1000 + i)) for i in range(150)]
    index = decontamination.ItemIndex.build(items, plan)
    near = found = 0
    for i, text in items:
        w = [x for x in (rng.choice([y, y, y, y, y, y, y + "s", None]) for y in text.split()) if x]
        doc = f"{prose(30, 5000 + i)} {' '.join(w)} {prose(30, 9000 + i)}"
        distance, _ = decontamination.edit_distance_within(decontamination.normalised(text), decontamination.normalised(doc))
        if distance <= 0.2 * len(text):
            near += 1
            found += (0, i) in decontamination._matches(index, [doc], plan)
    assert near > 80 and found >= 0.95 * near


def test_decontamination_of_short_items():
    """Items of 1 to 15 words are all found, verbatim and edited within the threshold."""
    rng, plan = random.Random(4), decontamination.Plan()
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    items = [(n * 100 + j, " ".join(letters(rng.randint(1, 6)) for _ in range(n))) for n in range(1, 16) for j in range(8)]
    index = decontamination.ItemIndex.build(items, plan)
    docs = [" ".join([*(letters(5) for _ in range(30)), t.upper(), *(letters(5) for _ in range(30))]) for _, t in items]
    got = decontamination._matches(index, docs, plan)
    assert all(got[i, i][0] == 0 for i in range(len(items)))
    edited, want = [], []
    for _, t in items:
        for j in rng.sample(range(len(t)), len(t) // 5):
            t = t[:j] + ("q" if t[j] != "q" else "z") + t[j + 1 :] if t[j] != " " else t
        edited.append(f"{letters(5)} {letters(7)} {t} {letters(5)}")
    got = decontamination._matches(index, edited, plan)
    for i, doc in enumerate(edited):
        for j, text in enumerate(index.texts):
            distance, _ = decontamination.edit_distance_within(text, doc)
            if 5 <= len(text) <= decontamination.SHORT:
                assert ((i, j) in got) == (distance <= len(text) // 5)
    assert decontamination._matches(decontamination.ItemIndex.build([(1, "cat")], plan), ["concatenate", "a Cat!", "ca", "t"], plan) == {(1, 0): (0, 5)}


def _letters(t, share, rng):
    t = list(t)
    for j in rng.sample(range(len(t)), int(share * len(t))):
        kind = rng.random()
        t[j] = rng.choice("abcdefghijklmnopqrstuvwxyz") if kind < 0.6 else "" if kind < 0.8 else t[j] + rng.choice("abcdefghijklmnopqrstuvwxyz")
    return "".join(t)


def _words(t, share, rng):
    w, spent = t.split(), 0
    for j in rng.sample(range(len(w)), len(w)):
        if spent + len(w[j]) <= share * len(t):
            spent += len(w[j])
            w[j] = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in w[j]) if rng.random() < 0.7 else ""
    return " ".join(filter(None, w))


def _every(t, k, rng):
    w = t.split()
    for i in range(0, len(w), k):
        j = rng.randrange(len(w[i]))
        w[i] = w[i][:j] + rng.choice("qxzw") + w[i][j + 1 :]
    return " ".join(w)


@pytest.mark.parametrize(("how", "shares"), [(_letters, (0.05, 0.1, 0.15, 0.19)), (_words, (0.05, 0.1, 0.15, 0.2)), (_every, (1, 2, 3, 4))])
def test_decontamination_equals_brute_force(spark, how, shares):
    """Of all pairs of a document and an item within the exact threshold, 19 of 20 at least are found, and no others."""
    rng, plan = random.Random(5), decontamination.Plan()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()]
    hosts = [r.text[:300] for r in spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) > 300").orderBy("doc_id").limit(len(items)).collect()]
    index = decontamination.ItemIndex.build(items, plan)
    for share in shares:
        docs = [f"{h[:150]} {how(t, share, rng)} {h[150:]}" for h, (_, t) in zip(hosts, items, strict=True)]
        want = {}
        for i, doc in enumerate(docs):
            for j, text in enumerate(index.texts):
                distance, _ = decontamination.edit_distance_within(text, decontamination.normalised(doc))
                if distance <= decontamination.allowed(len(text), plan):
                    want[i, j] = distance
        got = {k: d for k, (d, _) in decontamination._matches(index, docs, plan).items()}
        assert len(want) > 10 and len(got) >= 0.95 * len(want) and all(want[k] == d for k, d in got.items())


def test_edit_distance_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        p, t = ("".join(rng.choice("abc") for _ in range(rng.randint(1, n))) for n in (9, 25))
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j, d in enumerate(t, 1):
                new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
            row = new
        assert decontamination.edit_distance_within(p, t)[0] == min(row)


def test_pii(spark, odd):
    texts = [None, "", "a@b.c_d@e.f", "😀é a.b@c.d +49 (030) 1234-567", "1.2.3.45.6.7.8.9 0001.2.3.255", "4845168114407329x", "1" * 100_000, "a." * 30_000 + "@", "1 2-" * 30_000, "x@y.z " * 3000, "write to jane22[at]example[dot]org", "server 10[.]0[.]0[.]1 up", "look at this. Then dot", "call (212) 555-1234 now", "order 212-555-1234", "contact bob at example dot com today"]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id int, text string, pii_text string")
    got = {r.doc_id: [(s.kind, s.start, s.stop, s.base) for s in r.spans] for r in pii.detect(df).collect()}
    assert got[0] == got[1] == got[6] == got[7] == got[12] == []
    assert got[2] == [("email", 0, 5, True), ("email", 5, 11, True)]
    assert got[3] == [("email", 3, 10, True), ("phone", 11, 29, True)]
    assert [s[0] for s in got[4]] == ["ip"] * 3 and got[5] == [("card", 0, 16, True)]
    assert len(got[9]) == 3000 and got[9][-1][1:3] == (17994, 17999)
    assert got[10] == [("email", 9, 34, False)] and got[11] == [("ip", 7, 21, False)]
    assert got[13] == [("phone", 5, 19, False)] and got[14] == [] and got[15] == [("email", 8, 30, False)]
    hand = {"ruf 030 1234567 an": "phone", "llamar al 612 345 678": "phone", "appeler le 06 12 34 56 78 demain": "phone", "in plain prose (415) 555-2671 stands": "phone", "a fe80::1ff:fe23 b": "ip", "4111/1111/1111/1111": "card", "3782.822463.10005": "card", "jane @ foo.org": "email"}
    clean = ["order 212-555-1234", "met at noon. Then dot", "am 01.12.2021 war", "at 12:30:45:10 we", "version 2[.]10[.]3[.]4", "see 1234.5678.9012.3456 x"]
    more = spark.createDataFrame([(i, t) for i, t in enumerate([*hand, *clean])], "doc_id int, text string")
    kinds = {r.text: {s.kind for s in r.spans} for r in pii.detect(more).collect()}
    assert {t: {k} for t, k in hand.items()} == {t: kinds[t] for t in hand} and not any(kinds[t] for t in clean)
    red = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert red[0] is None and red[1] == "" and red[3] == "😀é [EMAIL] [PHONE]" and red[12] == texts[12]
    assert pii.detect(odd).count() == len(ODD) and pii.redact(odd.limit(0)).count() == 0 and pii.redact(odd).columns == odd.columns


def test_pii_trees(spark):
    """On fresh examples each kind has its precision, a fair recall, and no feature that decides alone."""
    for kind, figures in pii.report(spark).items():
        assert figures["precision"] >= 0.85 and figures["recall"] >= 0.75, (kind, figures)
        assert figures["features"] >= 5 and figures["top_feature"] < 0.5, (kind, figures)


def test_quality_rules(spark, odd):
    got = {r.doc_id: r for r in quality_rules.judge(odd, sample=odd).collect()}
    assert not got[1].kept and got[1].n_words == 0 and got[6].kept and got[6].n_words == 60_000 and not got[9].kept
    rows = spark.createDataFrame([(1, "a b c a b c a"), (2, "a a a a"), (3, "x\ny\nx\n\n\nx"), (4, "a\x1cb c\x0bd")], "doc_id int, text string")
    by = {r.doc_id: r for r in quality_rules.judge(rows, sample=rows).collect()}
    assert (by[1].n_repeat_words, by[2].n_repeat_words, by[3].n_dup_lines, by[4].n_words) == (7, 4, 2, 3)
    assert quality_rules.judge(odd.limit(0), sample=odd.limit(0)).count() == 0
    estimates = quality_rules.estimate(odd)
    assert {e.rule for e in estimates} == set(quality_rules.RULES) and all(e.seconds > 0 for e in estimates)
    free = quality_rules.Rule("free", lambda: F.lit(False))
    dear = quality_rules.Rule("dear", lambda: F.length(F.regexp_replace("q_text", "[aeiou]+x", "")) < 0)
    cost = {e.rule.name: e.seconds for e in quality_rules.estimate(odd, rules=(free, dear))}
    assert cost["dear"] > 3 * cost["free"], "job start-up is not part of a rule's cost"


def test_url_rules(spark):
    rules = [url_filters.HostRule("block", "com", "/en/"), url_filters.HostRule("allow", "example.com", "/en/7"), *url_filters.PATTERNS]
    urls = ["HTTP://A.Example.COM/en/75", "http://x.com/en/", "http://notexample.com/en/7", "com", None, "", "http://com/en/1?x", "http://example.com?/en/7", "http://a.org/cgi-bin/x", "http://a.org/x.EXE", "://", "http://a.org/executive"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id int, url string, host string")
    got = [(r.host, r.path, r.rule, r.verdict) for r in url_filters.judge_urls(df, rules).orderBy("page_id").collect()]
    assert got[0] == ("a.example.com", "/en/75", "example.com/en/7", "allow") and got[1][2:] == ("com/en/", "block") and got[2][2:] == ("com/en/", "block")
    assert got[3] == got[4] == got[5] == ("", "", None, "allow") and got[6][2:] == ("com/en/", "block") and got[7] == ("example.com", "", None, "allow")
    assert got[8][3] == got[9][3] == "block" and got[10] == ("", "", None, "allow") and got[11][3] == "allow"
    # the index changes no verdict
    index = url_filters.RuleIndex.build(rules, {})
    plain = url_filters.RuleIndex([], list(rules), index.order)
    plain.by_token = {}
    assert all(index.judge(u) == plain.judge(u) for u in urls)
    assert url_filters.judge_urls(df.limit(0), rules).count() == 0
    assert url_filters.pattern_tokens(r"/wp-login\.php(?:[?#]|$)") == [{"wp", "login", "php"}] and url_filters.pattern_tokens(r"ab*c") == [set()]
    assert [sorted(w) for w in url_filters.pattern_tokens(r"/(?:ad|ads)/(?:click|track)")] == [["ad"], ["ads"]]
    assert not url_filters.RuleIndex.build(list(url_filters.PATTERNS), {}).always


def test_url_patterns_decide(spark):
    """A URL for each pattern rule, and near misses: verdicts as by plain search, through the index."""
    hit = ["/wp-login.php", "/x?phpsessionid=1", "/x?a=1&jsessionid=2", "/cgi-bin/a", "/checkout/cart", "/a.exe?x", "/ads/click", "/ad/tracker", "/wp-admin/", "/xmlrpc.php", "/p?replytocom=4", "/login", "/cart/add/3", "/f.zip", "/email-this-page"]
    miss = ["/wp-login.phpx", "/jsessionid=2", "/checkout/carts", "/executive", "/adsclick", "/logins", "/f.zipper", "/cart/address"]
    urls = ["http://h.org" + x for x in [*hit, *miss]] + ["http://ad.doubleclick.net/x", "http://x.adnxs.com/", "http://notdoubleclick.net/x"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string")
    got = {r.url: r.verdict for r in url_filters.judge_urls(df, list(url_filters.PATTERNS)).collect()}
    assert [got[u] == "block" for u in urls] == [True] * len(hit) + [False] * len(miss) + [True, True, False]


def test_token_scan_across_blocks(spark, odd, tmp_path):
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 50, 3000).astype("<u2")
    ids[100:900] = 1  # a document over many blocks
    raw = ids.tobytes() + b"\x01"
    for name, data in (("a.bin", raw), ("b.bin", b""), ("c.bin", np.array([7, 7, 5], "<u2").tobytes())):
        (tmp_path / name).write_bytes(data)
    files = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in ("a.bin", "b.bin", "c.bin")], "path string")
    for block in (2, 64, 1 << 20):
        got = token_counts.count_documents(token_counts.file_sizes(spark, files), 7, 2, block).collect()
        ends = np.flatnonzero(ids == 7)
        starts = np.concatenate([[0], ends + 1])
        a = sorted((r.ordinal, r.start, r.n_tokens, r.closed) for r in got if r.path.endswith("a.bin"))
        want = [(i, s, e - s, True) for i, (s, e) in enumerate(zip(starts[:-1], ends, strict=True))]
        want += [(len(ends), starts[-1], 3000 - starts[-1], False)] if starts[-1] < 3000 else []
        assert a == want
        assert sorted((r.ordinal, r.n_tokens, r.closed) for r in got if r.path.endswith("c.bin")) == [(0, 0, True), (1, 0, True), (2, 1, False)]
        assert not [r for r in got if r.path.endswith("b.bin")]
    manifest = token_counts.write_token_files(odd, shared_dir(spark, "t"))
    assert manifest.count() == len(ODD)
    assert token_counts.write_token_files(odd.limit(0), shared_dir(spark, "t")).count() == 0
    with pytest.raises(ValueError):
        token_counts.write_token_files(odd, shared_dir(spark, "t"), end_id=1 << 16)


def test_tokenizer_equals_plain():
    t = WordTokenizer(default_path(), memory=50)
    texts = ["It's 'street don't(x)y's 12ab3 é́x İI ﬁ", None, "", " ", "hé,'s日本語！ok 12.5% a'll'd 's's", "a\x1cb\xa0c <|endoftext|> x<|endoftext|>y", "ΑΣ Σ. ≮ ≠x", *[prose(40, i) for i in range(5)]]
    assert [t.plain(x or "").tolist() for x in texts] == [y.tolist() for y in t.encode(texts)]
    other = WordTokenizer(default_path("byte_bpe_50k.json"))
    plain = [x or "" for x in texts if "<|" not in (x or "")]
    assert [other.plain(x).tolist() for x in plain] == [y.tolist() for y in other.encode(plain)]
    s = WordTokenizer(default_path(), specials_as_text=True)
    assert 49407 not in s.encode(["a <|endoftext|> b"])[0].tolist()


def test_packing(spark, odd):
    got = packing.pack(odd).collect()
    assert sum(r.length for r in got if r.doc_id == 1) == 1 and {r.doc_id for r in got} == {r[0] for r in ODD}
    assert packing.pack(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd, tiers=(1000,))


def test_warc_round_trip_and_salvage(spark, tmp_path):
    rows = [(1, "http://a/ b", "x" * 50), (2, None, "x" * 50), (3, "http://c", None), (4, "http://d", ""), (None, "http://e", "unique é"), (6, "http://f", "WARC/1.1\r\nfake"), (7, "u", "y" * 300_000)]
    df = spark.createDataFrame([(*r, "s") for r in rows], "page_id long, url string, html string, sha string").coalesce(1)
    files = warc.write_archives(df, shared_dir(spark, "w"), "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8"))
    got = warc.read_archives(files).select("*", warc.id_of("warc-record-id").alias("id"), warc.id_of("warc-refers-to").alias("to")).collect()
    by = {r.id: r for r in got}
    assert len(got) == len(rows) and by[2].headers["warc-type"] == "revisit" and by[2].to == 1 and by[2].payload_bytes == 50
    assert by[4].to == 3 and by[None].payload.decode() == "unique é" and by[6].payload == b"WARC/1.1\r\nfake"
    assert warc.write_archives(df.limit(0), shared_dir(spark, "w"), "page_id", "url", F.lit(b"")).count() == 0
    # damage: a byte inside a member, a cut end
    whole = b"".join(open(r.path.removeprefix("file://"), "rb").read() for r in files.collect())
    order = sorted((r for r in got if r.kind == "record"), key=lambda r: (r.path, r.offset))
    if files.count() == 1:
        second = order[1]
        hurt = bytearray(whole[:-9])
        hurt[second.offset + second.length // 2] ^= 0xFF
        (tmp_path / "hurt.warc.gz").write_bytes(bytes(hurt))
        rest = warc.read_archives(spark.createDataFrame([(f"file://{tmp_path}/hurt.warc.gz",)], "path string")).collect()
        gaps = sorted((r.offset, r.length) for r in rest if r.kind == "gap")
        assert gaps[0] == (second.offset, second.length) and len(gaps) == 2 and gaps[1][0] + gaps[1][1] == len(hurt)
        assert sum(r.kind == "record" for r in rest) == len(rows) - 2


def test_warc_plain_files(spark, tmp_path):
    import base64
    import hashlib

    digest = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    good = [warc.record(i, f"http://h/{i}", p, digest(p), None) for i, p in enumerate([b"one", b"two WARC/1.0\r\n three", b"four" * 99_999])]
    bad = warc.record(9, "http://bad", b"lie", digest(b"truth"), None)
    (tmp_path / "x.warc").write_bytes(b"junk\r\n" + good[0] + bad + good[1] + b"\x00\x01" + good[2])
    got = warc.read_archives(spark.createDataFrame([(f"file://{tmp_path}/x.warc",)], "path string")).collect()
    assert [r.payload for r in got if r.kind == "record"] == [b"one", b"two WARC/1.0\r\n three", b"four" * 99_999]
    assert [(r.length, r.reason) for r in got if r.kind == "gap"] == [(6, "no version line"), (len(bad), "payload digest differs"), (2, "no version line")]


def test_warc_salvage_inside_a_member():
    """A file compressed as one stream keeps its good records, whatever one of them or its end is like."""
    import base64
    import gzip
    import hashlib

    import pyarrow as pa

    def read(data):
        got = list(warc.salvage(warc.Source(pa.BufferReader(data), len(data))))
        return [warc.payload_of(g[3], g[4]) for g in got if g[0] == "record"], [g[3] for g in got if g[0] == "gap"]

    digest = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    rng = random.Random(6)
    bodies = [rng.randbytes(3000) for _ in range(5)]
    good = [warc.record(i, f"http://h/{i}", p, digest(p), None) for i, p in enumerate(bodies)]
    lie = warc.record(9, "http://h/9", b"lie", digest(b"truth"), None)
    broken = good[2].replace(b"Content-Length: ", b"Content-Length ")
    assert read(gzip.compress(b"".join([*good[:2], lie, *good[2:]]))) == (bodies, ["payload digest differs"])
    assert read(gzip.compress(b"".join([*good[:2], broken, *good[3:]])))[0] == bodies[:2] + bodies[3:]
    whole = gzip.compress(b"".join(good))
    got, gaps = read(whole[: len(whole) * 7 // 10])
    assert got == bodies[:3] and gaps
    hurt = bytearray(whole)
    hurt[-6] ^= 0xFF  # the checksum
    got, gaps = read(bytes(hurt) + gzip.compress(good[0]))
    assert got == [*bodies, bodies[0]] and gaps == ["bad gzip member"]
    ten = [warc.record(i, "u", p, digest(p), None) for i, p in enumerate(rng.randbytes(900) for _ in range(10))]
    got, gaps = read(gzip.compress(b"".join([*ten[:4], lie, *ten[4:]])))
    assert len(got) == 10 and gaps == ["payload digest differs"]
    assert len(read(gzip.compress(b"".join([*ten[:4], lie, *ten[4:]]))[:-20])[0]) >= 9
    old = [g.replace(b"WARC/1.1", b"WARC/0.18", 1) for g in good]
    assert read(gzip.compress(b"".join(old))) == (bodies, []) == read(b"".join(old))


def test_warc_memory_follows_a_record():
    """A member of many records is read piece by piece, as is a long stretch of junk in it."""
    import base64
    import gzip
    import hashlib
    import tracemalloc

    import pyarrow as pa

    body = bytes(200_000)
    one = warc.record(1, "u", body, base64.b32encode(hashlib.sha1(body).digest()).decode(), None)
    data = gzip.compress(one * 60 + b"\0" * 30_000_000 + one * 60)
    tracemalloc.start()
    kinds = [(g[0], g[3] if g[0] == "gap" else len(g[4])) for g in warc.salvage(warc.Source(pa.BufferReader(data), len(data)))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [k for k, _ in kinds] == ["record"] * 60 + ["gap"] + ["record"] * 60 and peak < 15_000_000


def test_small_helpers(spark):
    assert fresh(spark.range(1).withColumnRenamed("id", "A"), "a") == "a_1"
    v = np.array([5, 6, 7, 5, 6, 7], np.uint32)
    h = span_hashes(v, np.array([0, 3, 0]), np.array([3, 6, 2]))
    assert h[0] == h[1] != h[2]
    assert written(spark.range(3), "x").count() == 3
