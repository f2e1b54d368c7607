"""Column functions on text, native expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode knows it (fixed values).
WHITE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"([\p{L}\p{N}_]+)"


def text(c: Column | str) -> Column:
    """A string, '' for null."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """``c`` without white space at its ends: one pass from each end."""
    return F.regexp_extract(c, f"(?s)^[{WHITE}]*+(.*[^{WHITE}])", 1)


def told(c: Column) -> Column:
    """Whether ``c`` holds more than white space."""
    return c.rlike(f"[^{WHITE}]")


def filled(c: Column) -> Column:
    """Null for an empty string."""
    return F.nullif(c, F.lit(""))


def count_of(c: Column, what: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return F.floor((F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))) / len(what)).cast("long")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row: what stands in a
    lambda's body is evaluated again for every element, a bound value is not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def once(value: Column) -> Column:
    """``value``, computed where it stands.  Catalyst moves a filter below the
    projection that makes its columns and makes these there again; below a
    projection that isn't deterministic it moves none."""
    return F.when(F.spark_partition_id() >= 0, value)


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(1))


def runs_of(tokens: Column, n: int, short: Column) -> Column:
    """Distinct runs of ``n`` tokens joined by spaces; of fewer tokens, ``short``."""
    many = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " ")))
    return F.when(F.size(tokens) >= n, many).otherwise(short)


def shingles(c: Column, tokens: Column, n: int = 5) -> Column:
    """Word shingles of a lower-cased text; a short text is its own shingle, an empty one has none."""
    none = F.array().cast("array<string>")
    return runs_of(tokens, n, F.when(c != "", F.array(c)).otherwise(none))


def plain_ascii(c: Column) -> Column:
    """Lower-cased letters, digits and single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text(c)), "[^a-z0-9 ]+", " "), " +", " "))


def grams(tokens: Column, n: int = 8) -> Column:
    """Runs of ``n`` tokens; fewer tokens are one run, none are none."""
    return runs_of(tokens, n, F.when(F.size(tokens) > 0, F.array(F.array_join(tokens, " "))).otherwise(F.array().cast("array<string>")))


def unit_hash(seed: int, key: Column) -> Column:
    """A uniform number in [0, 1): the first eight bytes of SHA-256 of "seed:key"."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key), 256), 1, 16)
    return F.conv(head, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(18446744073709551616.0)


def paragraphs(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "\n\n"), strip), lambda p: p != "")


def _both(reasoning: Column, answer: Column) -> Column:
    return F.struct(reasoning.cast("string").alias("reasoning"), answer.cast("string").alias("answer"))


def _last_apart(parts: Column, several, one) -> Column:
    """``several(all but the last, the last)`` of two paragraphs or more, else ``one``."""
    n = F.size(parts)
    return F.when(n > 1, several(F.array_join(F.slice(parts, F.lit(1), F.greatest(n - 1, F.lit(0))), "\n\n"), F.try_element_at(parts, F.lit(-1)))).otherwise(one)


def think_parts(c: Column) -> Column:
    """struct<reasoning (null if none), answer> of a text with a think block.

    A closed block: what stands inside and after it; an empty answer is the
    whole text.  An open block: all paragraphs but the last, and the last; a
    single paragraph is both.  No block: no reasoning.

    The text is cut at the first opening tag and the rest at the first closing
    one; every value is bound, so each pattern runs once a row.
    """
    open_block = lambda body: bound(paragraphs(body), lambda parts: _last_apart(parts, _both, _both(filled(body), body)))
    closed = lambda whole, halves: bound(
        F.transform(halves, strip), lambda h: _both(filled(F.get(h, F.lit(0))), F.coalesce(filled(F.get(h, F.lit(1))), strip(whole)))
    )
    block = lambda whole, rest: bound(F.split(rest, "(?i)</think>", 2), lambda halves: F.when(F.size(halves) > 1, closed(whole, halves)).otherwise(bound(strip(rest), open_block)))
    return bound(text(c), lambda whole: bound(F.split(whole, "(?i)<think>", 2), lambda cuts: F.when(F.size(cuts) > 1, block(whole, F.get(cuts, F.lit(1)))).otherwise(_both(F.lit(None), strip(whole)))))


def last_boxed(c: Column) -> Column:
    """What the last ``\\boxed{`` holds, braces balanced; null if unbalanced or blank."""
    inner = bound(F.element_at(F.split(c, r"\\boxed\{", -1), -1), _balanced)
    return F.when(F.contains(c, F.lit("\\boxed{")), inner)


def _balanced(tail: Column) -> Column:
    """What stands before the brace that closes ``tail``; null if none does, or for a blank."""
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"))
    step = lambda a, ch: F.when(a["end"] > 0, a).otherwise(
        F.struct(
            (a["depth"] + F.when(ch == "{", 1).when(ch == "}", -1).otherwise(0)).alias("depth"),
            (a["at"] + 1).alias("at"),
            F.when((a["depth"] == 1) & (ch == "}"), a["at"] + 1).otherwise(0).alias("end"),
        )
    )
    end = F.aggregate(F.split(tail, ""), start, step)["end"]
    return bound(end, lambda e: F.when(e > 0, filled(strip(F.substring(tail, F.lit(1), e - 1)))))


#: Expected answers that name no value (fixed values).
NO_VALUE = ("proof", "notfound", "none", "n/a")


def prose_parts(c: Column, expected: Column) -> Column:
    """struct<reasoning, answer> of plain prose: the expected answer, else the last
    boxed one, makes a closing line; else the last paragraph answers."""

    def parts(whole: Column) -> Column:
        given = bound(strip(text(expected)), lambda e: F.when(~F.lower(e).isin(*NO_VALUE), filled(e)))
        closing = lambda found: F.concat(F.lit("The final answer is $\\boxed{"), found, F.lit("}$."))
        by_paragraph = bound(paragraphs(whole), lambda p: _last_apart(p, _both, _both(F.lit(None), whole)))
        found = bound(F.coalesce(given, last_boxed(whole)), lambda f: F.when(f.isNotNull(), _both(whole, closing(f))).otherwise(by_paragraph))
        return F.when(whole == "", _both(F.lit(None), F.lit(""))).otherwise(found)

    return bound(strip(text(c)), parts)
