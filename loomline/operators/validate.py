"""Final gates, manifests and the dataset card."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reasoning import CLIPPED

#: Licence texts that ask for a look before commercial use (fixed values): the card's and the validator's.
CARD_FLAGS = ("cc-by-nc", "non-commercial", "check-card")
WIDE_FLAGS = ("nc", "non-commercial", "check-card")


def flagged_license(license: Column, flags: tuple[str, ...] = CARD_FLAGS) -> Column:
    low = F.lower(F.coalesce(license, F.lit("")))
    out = F.lit(False)
    for flag in flags:
        out = out | F.contains(low, F.lit(flag))
    return out


def mode_shares(records: DataFrame) -> DataFrame:
    """One row: records with reasoning, and the shares that are off and clipped."""
    n = F.count_if(F.col("mode_label") != "off_nonreasoning")
    return records.agg(n.alias("n_reasoning"), (F.count_if(F.col("mode_label") == "off") / n).alias("off_share"), (F.count_if(F.col("mode_label") == "truncated") / n).alias("truncated_share"))


@dataclass
class Gates:
    """Results by gate; critical ones decide."""

    results: dict[str, bool] = field(default_factory=dict)
    critical: set[str] = field(default_factory=set)

    def add(self, name: str, passed: bool, critical: bool = False) -> None:
        self.results[name] = bool(passed)
        if critical:
            self.critical.add(name)

    @property
    def passed(self) -> bool:
        return all(ok for name, ok in self.results.items() if name in self.critical)


def clipped_on_target(shares: dict, tolerance: float = 0.02, target: float = CLIPPED) -> bool:
    return not shares["n_reasoning"] or abs(shares["truncated_share"] - target) <= tolerance


def manifest(df: DataFrame, by: list[str]) -> str:
    """A small aggregate as JSON text, ratios rounded to three places as Python does."""
    rows = [{k: round(v, 3) if isinstance(v, float) else v for k, v in r.asDict().items()} for r in df.orderBy(*by).collect()]
    return json.dumps(rows, indent=2, ensure_ascii=False)


def card(title: str, seed: int, sources: list[dict], benchmarks: dict, eval_grams: int, stages: list[dict], objects: list[dict]) -> str:
    """The dataset card in Markdown: a table for each manifest."""
    flags = [s["name"] for s in sources if any(f in str(s.get("license", "")).lower() for f in CARD_FLAGS)]
    facts = [{"fact": "seed", "value": seed}, {"fact": "word runs of benchmarks", "value": eval_grams}, {"fact": "licences to check", "value": ", ".join(sorted(set(flags))) or "none"}]
    tested = [{"benchmark": name, "questions": n} for name, n in benchmarks.items()]
    parts = {"Facts": facts, "Mixture": stages, "Files": objects, "Origin of the records": sources, "Benchmarks kept out": tested}
    return "\n\n".join([f"# {title}", *(f"## {name}\n\n{_table(rows)}" for name, rows in parts.items() if rows)]) + "\n"


def _table(rows: list[dict]) -> str:
    names = list(dict.fromkeys(k for r in rows for k in r))
    line = lambda cells: "| " + " | ".join(str(c) for c in cells) + " |"
    return "\n".join([line(names), line("-" for _ in names), *(line(r.get(n, "") for n in names) for r in rows)])


def round_trip(encode, decode, samples: list[str], tags: tuple[str, ...] = (), most: int = 3) -> dict[str, bool]:
    """Whether a tokenizer gives samples back, and keeps each tag within ``most`` tokens."""
    out = {f"sample {i}": decode(encode(s)) == s for i, s in enumerate(samples)}
    return out | {f"tag {t}": 0 < len(encode(t)) <= most for t in tags}
