"""The whole curation as one plan, with stages that resume from what was written.

A stage is done when its folder holds ``_SUCCESS`` and was written with the same
settings.  The decontamination gate's
result is written beside the data and is asked for before anything that comes
after it, however a run was resumed.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.storage import cut
from ..operators import decontam, dedup, mix, quality, reasoning, render, split, validate
from ..sources import io
from ..sources.catalog import Source, as_table
from .bindings import items


@dataclass(frozen=True)
class Settings:
    """What may differ between runs."""

    seed: int = 42
    budgets: dict[str, float] = field(default_factory=dict)
    recipes: dict[str, dict[str, float]] = field(default_factory=dict)
    replay: float = 0.0
    exclusive: tuple[str, ...] = ()
    longest: tuple[str, ...] = ()
    hardest: tuple[str, ...] = ()
    first_sources: tuple[str, ...] = ()
    test_share: float = 0.05
    threshold: float = decontam.THRESHOLD

    def budget(self, stage: str, environment: dict | None = None) -> float:
        """A stage's tokens; LOOMLINE_<STAGE>_TOKENS overrides it."""
        value = (os.environ if environment is None else environment).get(f"LOOMLINE_{stage.upper()}_TOKENS")
        return int(float(value)) if value else self.budgets[stage]


def _stage(spark: SparkSession, path: str, make: Callable[[], DataFrame], key: str = "", force: bool = False) -> DataFrame:
    """What was written to ``path`` under the same ``key`` (settings and inputs), or ``make()`` written there now."""
    mark = f"{path}.key"
    kept = json.loads(spark.read.text(mark).first()["value"]) if io.exists(spark, mark) and io.done(spark, path) else {}
    if force or kept.get("key") != key:
        made = make()
        io.write_stage(made, path)
        kept = {"key": key, "schema": made.schema.jsonValue()}
        _write_text(spark, json.dumps(kept), mark)
    return spark.read.schema(StructType.fromJson(kept["schema"])).parquet(path)


def curate(spark: SparkSession, raw: dict[str, DataFrame], sources: list[Source], benchmark: DataFrame, root: str, settings: Settings, force: bool = False) -> dict[str, DataFrame]:
    """Records through filter, dedup, decontamination, modes, mix and split.

    ``raw``: records by source name.  Returns the written stages and the rows
    of each mix stage with their side.  A stage is taken as it was written if
    settings and sources are the same; ``force`` makes all anew.
    """
    key = json.dumps([asdict(settings), sorted(raw), [s.name for s in sources]], sort_keys=True)
    stage = functools.partial(_stage, key=key, force=force)
    catalog = as_table(spark, sources)
    allin = None
    for df in raw.values():
        allin = df if allin is None else allin.unionByName(df)
    clean = stage(spark, f"{root}/clean", lambda: quality.quality_filter(allin))
    first = F.when(F.col("source").isin(list(settings.first_sources)), 0).otherwise(1)

    def deduped() -> DataFrame:
        at = clean.withColumn("prio", first)
        return dedup.near_duplicates(at, render.record_text(F.col("messages")), ["prio", "source_rank", "idx"]).filter("dropped IS NULL").drop("dropped", "prio")

    unique = stage(spark, f"{root}/unique", deduped)
    index = decontam.eval_index(benchmark)
    users = render.user_text(F.col("messages"))
    safe = stage(spark, f"{root}/safe", lambda: decontam.clean(unique, "id", users, index, settings.threshold))
    require_gate(spark, safe, users, index, f"{root}/gate.json", settings.threshold)
    formatted = stage(spark, f"{root}/formatted", lambda: reasoning.assign(safe, settings.seed))
    reasoning.require_reasoning(formatted, catalog)
    narrow = cut(items(formatted))
    own = narrow.filter(~F.col("source").isin(list(settings.exclusive)))
    first_mix = cut(mix.stage_mix(own, settings.recipes["stage1"], settings.budget("stage1"), settings.seed, "stage1"))
    second = mix.stage_mix(own, settings.recipes["stage2"], settings.budget("stage2") * (1 - settings.replay), settings.seed, "stage2")
    second = second.unionByName(mix.replay(first_mix, settings.budget("stage2") * settings.replay, settings.seed), allowMissingColumns=True)
    third = mix.polish_stage(narrow, list(settings.exclusive), list(settings.longest), list(settings.hardest), settings.budget("stage3"))
    out = {"clean": clean, "unique": unique, "safe": safe, "formatted": formatted}
    for name, chosen in (("stage1", first_mix), ("stage2", second), ("stage3", third)):
        rows = mix.gathered(chosen.select("name", "idx", "domain", "source", "source_rank", "tokens"), formatted)
        rows = rows.withColumn("conversations", render.conversations(F.col("messages"), F.col("meta.reasoning_mode"))).withColumn("key", split.row_key("conversations"))
        out[name] = split.train_test(rows, "key", share=settings.test_share, seed=settings.seed)
        split.require_rows(out[name], "conversations")
    return out


def finish(spark: SparkSession, out: dict[str, DataFrame], sources: list[Source], root: str, settings: Settings, benchmarks: dict | None = None) -> validate.Gates:
    """Write the stages' rows, manifests and the card below ``root``, and look at
    them again: the gates, of which lost objects and a failed decontamination are critical."""
    names = [n for n in ("stage1", "stage2", "stage3") if n in out]
    objects = []
    for name in names:
        sides = {side: io.object_key(root, "data", name, side) for side in ("train", "test")}
        for side, path in sides.items():
            io.write_json_lines(out[name].filter(F.col("side") == side).select("conversations"), path)
        counts = {r["side"]: r["n"] for r in out[name].groupBy("side").agg(F.count("*").alias("n")).collect()}
        objects.append({"stage": name, "train_key": sides["train"], "test_key": sides["test"], "n_train": counts.get("train", 0), "n_test": counts.get("test", 0)})
    chosen = [out[n].select(F.lit(n).alias("stage"), "name", "idx", "domain", "tokens") for n in names]
    selected = cut(functools.reduce(DataFrame.unionByName, chosen))
    report = mix.mixture_report(selected)
    stages = mix.stage_report(selected)
    licensed = out["formatted"].groupBy("name", "license").agg(F.count("*").alias("retained"))
    tables = {"mixture": (report, ["stage", "domain"]), "stages": (stages, ["stage"]), "sources": (licensed, ["name", "license"])}
    for name, (table, by) in tables.items():
        _write_text(spark, validate.manifest(table, by), f"{root}/manifests/{name}.json")
    _write_text(spark, json.dumps(objects, indent=2), f"{root}/manifests/objects.json")
    gate = json.loads(spark.read.text(f"{root}/gate.json").first()["value"])
    shares = validate.mode_shares(out["formatted"]).first().asDict()
    fit = mix.fidelity(report, {k: v for k, v in settings.recipes.items() if k in names})
    rows = [{"id": r["name"], "name": r["name"], "license": r["license"], "retained": r["retained"]} for r in licensed.orderBy("name").collect()]
    _write_text(spark, validate.card("Curated corpus", settings.seed, rows, benchmarks or {}, gate["n_eval"], [r.asDict() for r in stages.orderBy("stage").collect()], objects), f"{root}/CARD.md")
    gates = validate.Gates()
    gates.add("decontamination", gate["passed"], critical=True)
    gates.add("clipped share", validate.clipped_on_target(shares))
    gates.add("domain shares", fit.filter("NOT on_target").isEmpty())
    gates.add("licences", not any(f in str(r["license"]).lower() for r in rows for f in validate.CARD_FLAGS))
    gates.add("objects", all(io.done(spark, o[k]) for o in objects for k in ("train_key", "test_key")), critical=True)
    _write_text(spark, json.dumps(gates.results), f"{root}/manifests/gates.json")
    return gates


def _write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text, made on the driver, as one file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def require_gate(spark: SparkSession, records: DataFrame, body, index: DataFrame, path: str, threshold: float) -> None:
    """Scan the output again and keep the result; raise unless it passes."""
    row = decontam.gate(records, "id", body, index, threshold).first().asDict()
    spark.createDataFrame([(json.dumps(row),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    if not row["passed"]:
        raise ValueError(f"decontamination gate: {row}")
