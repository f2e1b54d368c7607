"""Personal data: base spans, and further spans that boosted trees select.

Everything on the data runs as native DataFrame expressions.  Base detectors
are exact patterns with checks (digit counts, Luhn, ranges).  High-recall
generators, several for each kind, propose further, overlapping spans:
addresses written with "at" and "dot" or with spaces, bracketed and version 6
IP addresses, cards in other groups and separators, telephone numbers as North
America and several European countries write them.  Format and context
features of each proposal go through gradient-boosted trees, which are CASE
expressions in the plan, and thresholds, calibrated per kind for precision on
held-out examples, select the spans that are added.  Of proposals of a kind
that overlap the one with the highest score stays.

The trees are trained on the driver, from examples that this module writes
itself with fixed seeds, in four languages: personal data with and without a
word that announces it, and as hard negatives orders, versions, dates and
serial numbers of the same shape, also after such words.  ``report`` gives
recall and precision on further examples.

Positions are code points, end exclusive.  Patterns are written so that Java
needs neither a deep stack nor quadratic time on long runs: possessive loops,
and a start only at the end of the last match or where a run begins.

Defined results: a null text counts as empty and has no span; very long texts
are searched whole.  Repeated rows are searched one by one.  Spans that start
together are ordered by kind, then end; of overlapping proposals with equal
scores the first stays.  Working columns avoid the names of the table's own.
An empty table gives no row.
"""

from __future__ import annotations

import random
from functools import lru_cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import fresh
from .gradient_boosting import Boosted, calibrated_threshold, fit

KINDS = ("email", "ip", "card", "phone")

#: Patterns of the base detectors; a group (?:\G|...) stands for "leftmost, and no start inside a run".
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of these has no base span of the kind: a cheap look first.
GATE = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

#: Further proposals: (kind, gate, pattern).  Shapes that can't overlap share a pattern.
GENERATORS = (
    ("email", r"(?i)[\[( {]at[\]) }]", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+\x20?(?:\[at\]|\(at\)|\{at\}|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\[dot\]|\(dot\)|\{dot\}|\x20dot\x20|\.)\x20?[A-Za-z0-9-]{2,63}+){1,4}+"),
    ("email", r"\x20@|@\x20", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+\x20?@\x20?[A-Za-z0-9-]{1,63}+(?:\x20?\.\x20?[A-Za-z0-9-]{2,63}+){1,4}+"),
    # bracketed, and version 6 in full or with a gap
    ("ip", r"[0-9]\[\.\][0-9]|[0-9A-Fa-f]::?[0-9A-Fa-f]{1,4}:?", r"(?<![0-9A-Za-z:.\]])(?:[0-9]{1,3}+(?:\[\.\][0-9]{1,3}+){3}(?![0-9])|(?:[0-9A-Fa-f]{1,4}+:){3,7}[0-9A-Fa-f]{1,4}+(?![0-9A-Za-z:])|(?:[0-9A-Fa-f]{1,4}+:){1,6}(?::[0-9A-Fa-f]{1,4}+){1,5}(?![0-9A-Za-z:]))"),
    # four groups of four with other separators, and 4-6-5
    ("card", r"[0-9]{4}[\x20._/\t-]{1,3}[0-9]{4}", r"(?<![0-9])(?:[0-9]{4}(?:[\x20._/\t-]{1,3}+[0-9]{4}){3}|3[0-9]{3}[._/][0-9]{6}[._/][0-9]{5})(?![0-9])"),
    # North American numbers, and three groups of three
    ("phone", r"[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{3}", r"(?<![0-9+(.-])(?:\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}|[679][0-9]{2}(?:\x20[0-9]{3}){2})(?![0-9-])"),
    # a leading 0 for the country, 00 for the world
    ("phone", r"0[0-9]{1,4}\)?[\x20./-]{1,2}[0-9]{2}|00[1-9][0-9]", r"(?<![0-9+(./-])(?:\(?0[1-9][0-9]{0,3}\)?[\x20./-]{1,2}+[0-9]{2,8}(?:[\x20.-][0-9]{2,4}){0,4}|00[1-9][0-9]{0,2}(?:[\x20.()-]{0,2}[0-9]{2,4}){2,5})(?![0-9-])"),
)
#: Context words before a span that speak for a kind, in four languages.
CONTEXT_WORDS = {
    "email": ("email", "e-mail", "mail", "contact", "write", "reach", "address", "correo", "courriel", "adresse", "schreiben", "kontakt", "contacto"),
    "ip": ("ip", "host", "server", "address", "login", "ping", "servidor", "serveur", "rechner", "dirección", "adresse"),
    "card": ("card", "visa", "master", "credit", "payment", "debit", "karte", "kreditkarte", "tarjeta", "carte", "zahlung", "pago", "paiement"),
    "phone": ("tel", "phone", "telephone", "call", "mobile", "fax", "sms", "cell", "telefon", "handy", "anrufen", "ruf", "teléfono", "llamar", "móvil", "téléphone", "appeler", "portable"),
}
CONTEXT = {kind: r"(?iu)(?<!\p{L})(?:" + "|".join(words) + r")(?!\p{L})[^\n]{0,20}$" for kind, words in CONTEXT_WORDS.items()}
#: Context words that speak against: figures, versions, orders, references, in four languages.
AGAINST_WORDS = ("version", "order", "invoice", "page", "isbn", "section", "figure", "part", "serial", "total", "ref", "no\\.", "bestellung", "rechnung", "seite", "nummer", "pedido", "factura", "página", "commande", "facture", "numéro")
AGAINST = r"(?iu)(?<!\p{L})(?:" + "|".join(AGAINST_WORDS) + r")(?!\p{L})[^\n]{0,12}$"
BLOCK = 64


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda a, i: a + F.when(i % 2 == 1, F.substring(digits, n - i + 1, F.lit(1)).cast("int")).otherwise(
            F.substring(digits, n - i + 1, F.lit(1)).cast("int") * 2 - F.when(F.substring(digits, n - i + 1, F.lit(1)) >= "5", 9).otherwise(0)
        ),
    )
    return (n > 0) & (F.when(n > 0, total).otherwise(1) % 10 == 0)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    """The check that a base match of ``kind`` must pass."""
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")
    n = F.length(digits_of(value))
    if kind == "card":
        return F.when(n.between(14, 19), luhn(digits_of(value))).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


SPAN = "array<struct<start:int,stop:int,value:string>>"


def find_spans(df: DataFrame, text: str, gate: str, pattern: str, check, out: str) -> DataFrame:
    """``df`` with the column ``out``: the matches of ``pattern`` that pass
    ``check``, with positions.

    Matches and the pieces between them come from the same search; a match
    starts where all pieces and matches before it end.  Lengths are summed in
    blocks first, so a text with very many matches costs no square.
    """
    found, pieces, sizes, sums, before = (fresh(df, f"{out}_{x}") for x in ("found", "pieces", "sizes", "sums", "before"))
    hit = F.col(text).rlike(gate)
    df = df.withColumn(found, F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    some = F.size(found) > 0
    df = df.withColumn(pieces, F.when(some, F.arrays_zip(F.col(found).alias("m"), F.split(text, pattern, -1).alias("p"))))
    df = df.withColumn(sizes, F.transform(pieces, lambda z: F.struct(F.length(z["p"]).alias("p"), F.coalesce(F.length(z["m"]), F.lit(0)).alias("m"))))
    add = lambda a, x: a + x["p"] + x["m"]
    df = df.withColumn(sums, F.when(some, F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda b: F.aggregate(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), add))))
    df = df.withColumn(before, F.when(some, F.transform(F.sequence(F.lit(0), F.size(sums) - 1), lambda b: F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0), lambda a, x: a + x))))
    block = lambda i: F.floor(i / BLOCK).cast("int")
    # both columns stand twice in the lambda: Catalyst then keeps them as columns, computed once a row
    start = lambda i: (
        F.when(F.size(before) > block(i), F.get(before, block(i))) + F.aggregate(F.slice(sizes, block(i) * BLOCK + 1, i % BLOCK), F.lit(0), add) + F.get(sizes, i)["p"]
    )
    kept = F.filter(F.transform(found, lambda m, i: F.struct(m.alias("value"), i.alias("i"))), lambda x: check(x["value"]))
    spans = F.transform(kept, lambda x: F.struct(start(x["i"]).alias("start"), (start(x["i"]) + F.length(x["value"])).alias("stop"), x["value"].alias("value")))
    df = df.withColumn(out, F.when(some, spans).otherwise(F.array().cast(SPAN)).cast(SPAN))
    return df.drop(found, pieces, sizes, sums, before)


FEATURES = (
    "length", "digits", "luhn", "separators", "kinds_of_separators", "context", "against", "letter_before", "letter_after", "digit_beyond", "line_alone",
    "words", "groups", "longest_group", "leading_zero", "distinct_digits", "octets", "plan", "date", "written_out", "hex_letters",
)


def features(kind: str, value: Column, before: Column, after: Column) -> list[Column]:
    """Format and context of one proposed span, in the order of ``FEATURES``."""
    digits = digits_of(value)
    yes = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    apart = F.regexp_replace(value, r"[0-9A-Za-z]", "")
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    return [
        F.length(value),
        F.length(digits),
        yes(luhn(digits)),
        F.length(value) - F.length(F.regexp_replace(value, r"[\x20._/()\[\]-]", "")),
        F.size(F.array_distinct(F.split(apart, ""))),
        yes(before.rlike(CONTEXT[kind])),
        yes(before.rlike(AGAINST)),
        yes(before.rlike(r"\p{L}$")),
        yes(after.rlike(r"^\p{L}")),
        yes(before.rlike(r"[0-9][\x20.,/-]?$") | after.rlike(r"^[\x20.,/-]?[0-9]")),
        yes((before == "") & (after == "")),
        F.size(F.split(value, r"\x20+")),
        F.size(groups),
        F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        yes(value.rlike(r"^\(?0")),
        F.size(F.array_distinct(F.split(digits, ""))),
        yes(digits.isNotNull() & F.forall(groups, lambda g: (F.length(g) <= 3) & (g.try_cast("int") <= 255))),
        # numbering plans: area and exchange from 2 on; cards by their first digits
        yes(value.rlike(r"^\(?[2-9][0-9]{2}\)?[\x20.-]?[2-9][0-9]{2}[\x20.-]" if kind == "phone" else r"^(?:4|5[1-5]|3[47]|6[05]|2[2-7])")),
        yes(value.rlike(r"(?<![0-9])(?:19|20)[0-9]{2}[\x20./-][01]?[0-9](?![0-9])|(?<![0-9])[0-3]?[0-9][./-][01]?[0-9][./-](?:19|20)?[0-9]{2}(?![0-9])")),
        yes(value.rlike(r"(?i)[\[({]at[\])}]|\x20dot\x20|[\[({]dot[\])}]|@")),
        yes(value.rlike(r"[A-Fa-f]")),
    ]


#: Frequent words of the four languages of the examples.
PROSE = {
    "en": "the of and to in is that for it with as was on are by this be at from or have".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur".split(),
}


def examples(kind: str, n: int, seed: int) -> list[tuple[str, str, str, int]]:
    """(value, before, after, label): proposals as the generators of ``kind``
    make them, half of them personal data, in invented context.

    Half of the personal data has an announcing word before it, and so has one
    in twenty of the others.  Of those, most follow a word that speaks against or
    stand in a longer number, others have an impossible format, and some differ
    in nothing but what they mean.
    """
    rng = random.Random(f"{kind}-{seed}")
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    syllables = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))

    def prose(k: int) -> str:
        frequent = PROSE[rng.choice(tuple(PROSE))]
        return " ".join(rng.choice(frequent) if rng.random() < 0.5 else syllables() for _ in range(k))

    def with_luhn(n: int, good: bool, start: str = "") -> str:
        body = start + d(n - 1 - len(start))
        total = sum(x * 2 - 9 * (x > 4) if i % 2 == 0 else x for i, x in enumerate(map(int, reversed(body))))
        return body + str((-total + (0 if good else rng.randint(1, 9))) % 10)

    def cut(digits: str, sizes: tuple[int, ...], sep: str) -> str:
        out, at = [], 0
        for size in sizes:
            out.append(digits[at : at + size])
            at += size
        return sep.join(out)

    def value(label: bool, odd: bool) -> str:
        if kind == "email":
            if not label:
                return rng.choice([f"{syllables()} at {syllables()}. {syllables()}", f"{rng.choice(PROSE['en'])} at {syllables()}.{syllables()}", f"{syllables()} @ {d(2)} . {d(3)}"])
            at, dot = rng.choice([("[at]", "[dot]"), ("(at)", "(dot)"), (" at ", " dot "), (" [at] ", "."), (" @ ", "."), ("@ ", " . ")])
            return f"{syllables()}{rng.choice(['', '.', '_'])}{syllables()}{d(rng.choice([0, 2]))}{at}{syllables()}{dot}{rng.choice(['com', 'org', 'net', 'de', 'fr', 'es'])}"
        if kind == "ip":
            if rng.random() < 0.5:
                most = rng.choice([9, 30, 255, 255])
                return "[.]".join(str(rng.randint(256, 999) if odd and rng.random() < 0.5 else rng.randint(0, most)) for _ in range(4))
            if label:
                return rng.choice([":".join(f"{rng.randrange(65536):x}" for _ in range(8)), f"fe80::{rng.randrange(65536):x}:{rng.randrange(65536):x}", f"2001:db8::{rng.randrange(65536):x}"])
            return ":".join(f"{rng.randint(0, 59):02d}" for _ in range(rng.choice([4, 5])))
        if kind == "card":
            sep = rng.choice("._/") if rng.random() < 0.6 else rng.choice(["  ", " - ", "\t"])
            if rng.random() < 0.25:
                return cut(with_luhn(15, label or rng.random() < 0.1, "37" if label or rng.random() < 0.5 else "31"), (4, 6, 5), rng.choice("._/"))
            return cut(with_luhn(16, label or rng.random() < 0.1, rng.choice(["4", "51", "55", "60"]) if label or rng.random() < 0.3 else rng.choice("1789")), (4, 4, 4, 4), sep)
        plain = not label and odd
        nanp = lambda: (rng.choice("01") if plain else rng.choice("23456789")) + d(2) + (rng.choice("01") if plain else rng.choice("23456789")) + d(2) + d(4)
        if plain and rng.random() < 0.5:
            return rng.choice([f"0{rng.randint(1, 9)}.{rng.randint(10, 12)}.20{d(2)}", f"0{rng.randint(1, 9)}/{rng.randint(10, 31)}"])
        digits = nanp()
        return rng.choice(
            [f"({digits[:3]}) {digits[3:6]}-{digits[6:]}", cut(digits, (3, 3, 4), rng.choice("-. ")), f"0{d(2)} {d(7)}", f"0{rng.choice('67')} {cut(d(8), (2, 2, 2, 2), ' ')}", f"01{d(2)}-{d(8)}", f"00{rng.choice(['49', '33', '34', '1'])} {d(3)} {d(3)} {d(3)}", f"{rng.choice('679')}{d(2)} {d(3)} {d(3)}"]
        )

    words, out = [w for w in CONTEXT_WORDS[kind] if w.isalpha()], []
    against = [w for w in AGAINST_WORDS if w.isalpha()]
    for _ in range(n):
        label, how = rng.random() < 0.5, rng.random()
        before = prose(rng.randint(0, 4))
        if rng.random() < (0.5 if label else 0.05):
            before += f" {rng.choice(words)}{rng.choice(['', ':', ' ' + rng.choice(PROSE['en'])])}"
        elif not label and how < 0.65:
            before += f" {rng.choice(against)}{rng.choice(['', ':', ' ' + rng.choice(PROSE['en'])])}"
        after = rng.choice([" ", ", ", ". "]) + prose(2)
        if not label and how > 0.88 and kind != "email":
            after = rng.choice([" ", "-", "."]) + d(2) + after
        out.append((value(label, 0.6 <= how < 0.85), (before + " ").lstrip()[-40:], after[:20], int(label)))
    return out


@lru_cache(maxsize=8)
def _trained(session: str, kind: str, n: int, precision: float) -> tuple[Boosted, float]:
    (x, y), (held_x, held_y) = _measured(kind, n, (0, 1))
    model = fit(x, y, trees=30, depth=3)
    return model, calibrated_threshold(model.logit(held_x), held_y, precision)


def _measured(kind: str, n: int, seeds: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of ``n`` examples of each seed, the features as the plan computes them."""
    spark = SparkSession.getActiveSession()
    made = [(seed, *row) for seed in seeds for row in examples(kind, n, seed)]
    rows = spark.createDataFrame(pd.DataFrame(made, columns=["seed", "value", "before", "after", "label"]))
    measured = F.array(*(c.cast("double") for c in features(kind, F.col("value"), F.col("before"), F.col("after"))))
    got = rows.select("seed", "label", measured.alias("f")).toPandas()
    parts = [got[got["seed"] == seed] for seed in seeds]
    return [(np.array(p["f"].tolist(), float), p["label"].to_numpy(float)) for p in parts]


def models(spark: SparkSession, n: int = 1500, precision: float = 0.9) -> dict[str, tuple[Boosted, float]]:
    """Trees and calibrated threshold per kind, from ``n`` training and ``n``
    calibration examples of each; the same on every run."""
    return {kind: _trained(spark.sparkContext.applicationId, kind, n, precision) for kind in KINDS}


def report(spark: SparkSession, n: int = 1500, precision: float = 0.9) -> dict[str, dict[str, float]]:
    """Per kind, on examples that neither trees nor thresholds have seen: recall,
    precision, and the share of splits on the most used feature."""
    out = {}
    for kind, (model, threshold) in models(spark, n, precision).items():
        ((x, y),) = _measured(kind, n, (2,))
        hit = model.logit(x) >= threshold
        used = np.bincount(model.features_used(), minlength=len(FEATURES))
        out[kind] = {"recall": float(hit[y == 1].mean()), "precision": float(y[hit].mean()) if hit.any() else 1.0, "top_feature": float(used.max() / max(1, used.sum())), "features": int((used > 0).sum())}
    return out


def _base_spans(column: str, kind: str) -> Column:
    no = KINDS.index(kind)
    return F.transform(
        column,
        lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("kind_no"), s["stop"].alias("stop"), F.lit(kind).alias("kind"), F.lit(True).alias("base"), F.lit(None).cast("double").alias("score")),
    )


def _measured_spans(column: str, body: str, kind: str) -> Column:
    """The proposals with their features."""
    before = lambda s: F.substring(F.col(body), F.greatest(s["start"] - 39, F.lit(1)), F.least(s["start"], F.lit(40)))
    after = lambda s: F.substring(F.col(body), s["stop"] + 1, F.lit(20))
    return F.transform(
        column, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.array(*(f.cast("double") for f in features(kind, s["value"], before(s), after(s)))).alias("f"))
    )


def _added_spans(column: str, base: str, kind: str, model: Boosted, threshold: float) -> Column:
    """The measured proposals that the trees accept and that touch no base span of their kind."""
    scored = F.expr(f"transform(`{column}`, s -> named_struct('start', s.start, 'kind_no', {KINDS.index(kind)}, 'stop', s.stop, 'kind', '{kind}', 'base', false, 'score', {model.sql('s.f[{}]')}))")
    clear = lambda s: ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    return F.filter(scored, lambda s: (s["score"] >= threshold) & clear(s))


def _best_of_overlapping(column: str) -> Column:
    """The spans that no overlapping one beats by score (of equal scores, the first)."""
    beats = lambda o, s: (o["start"] < s["stop"]) & (s["start"] < o["stop"]) & ((o["score"] > s["score"]) | ((o["score"] == s["score"]) & (F.struct(o["start"], o["stop"]) < F.struct(s["start"], s["stop"]))))
    return F.filter(column, lambda s: ~F.exists(column, lambda o: beats(o, s)))


def reach_before(stops: str, sums: str) -> tuple[Column, Column]:
    """How far the spans before each go: the greatest of the earlier ``stops``, in
    blocks, so that very many spans cost no square.  The first column is to be
    kept as ``sums``, of which the second is made."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(stops) - 1) / BLOCK).cast("int")), lambda b: F.array_max(F.slice(stops, b * BLOCK + 1, F.lit(BLOCK))))
    most = lambda items: F.coalesce(F.array_max(items), F.lit(0))
    block = lambda i: F.floor(i / BLOCK).cast("int")
    each = F.transform(F.sequence(F.lit(0), F.size(stops) - 1), lambda i: F.greatest(most(F.slice(sums, F.lit(1), block(i))), most(F.slice(stops, block(i) * BLOCK + 1, i % BLOCK))))
    return F.when(F.size(stops) > 0, blocks), F.when(F.size(stops) > 0, each)


def detect(docs: DataFrame, text: str = "text", out: str = "spans", precision: float = 0.9) -> DataFrame:
    """``docs`` with the column ``out``: an array, by start and kind, of
    struct<start, kind_no, stop, kind, base, score>.  ``score`` is the trees'
    logit of added spans."""
    trained = models(docs.sparkSession, precision=precision)
    body = fresh(docs, "pii_text")
    df = docs.withColumn(body, F.coalesce(F.col(text).cast("string"), F.lit("")))
    parts, work = [], [body]
    for kind in KINDS:
        column = fresh(df, f"pii_{kind}")
        df = find_spans(df, body, GATE[kind], BASE[kind], partial(valid, kind), column)
        work.append(column)
        parts.append(_base_spans(column, kind))
        model, threshold = trained[kind]
        found = []
        for _, gate, pattern in (g for g in GENERATORS if g[0] == kind and threshold < float("inf")):
            more = fresh(df, f"pii_more_{kind}")
            df = find_spans(df, body, gate, pattern, lambda v: F.lit(True), more)
            found.append(more)
        if found:
            added = fresh(df, f"pii_added_{kind}")
            df = df.withColumn(added, F.array_distinct(F.concat(*found))).drop(*found)
            df = df.withColumn(added, F.when(F.size(added) > 0, _measured_spans(added, body, kind)))
            df = df.withColumn(added, F.coalesce(_added_spans(added, column, kind, model, threshold), F.array().cast(ADDED)))
            df = df.withColumn(added, _best_of_overlapping(added))
            work.append(added)
            parts.append(F.col(added))
    return df.withColumn(out, F.sort_array(F.concat(*parts))).drop(*work)


ADDED = "array<struct<start:int,kind_no:int,stop:int,kind:string,base:boolean,score:double>>"


def redact(docs: DataFrame, text: str = "text", precision: float = 0.9) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in capitals and
    brackets; spans that overlap become one, named after the first.  A null
    text stays null."""
    at = fresh(docs, "pii_spans")
    df = detect(docs, text, at, precision)
    stops, blocks, ends = (fresh(df, f"pii_{x}") for x in ("stops", "blocks", "reach"))
    df = df.withColumn(stops, F.transform(at, lambda s: s["stop"]))
    in_blocks, each = reach_before(stops, blocks)
    df = df.withColumn(blocks, in_blocks).withColumn(ends, each)
    # a span that starts before the spans before it end is part of an earlier one
    piece = lambda s, i: F.when(
        s["start"] >= F.get(ends, i),
        F.concat(F.substring(F.col(text), F.get(ends, i) + 1, s["start"] - F.get(ends, i)), F.lit("["), F.upper(s["kind"]), F.lit("]")),
    ).otherwise(F.lit(""))
    body = F.concat(F.array_join(F.transform(at, piece), ""), F.substring(F.col(text), F.array_max(stops) + 1, F.length(text)))
    return df.withColumn(text, F.when(F.size(at) > 0, body).otherwise(F.col(text))).drop(at, stops, blocks, ends)
