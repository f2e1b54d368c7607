"""The registered queries of the engine, and the SQL that says the same in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WHITE, count_of, once, plain_ascii, prose_parts, strip, text, think_parts, unit_hash, words
from ..functions.storage import cut, shared_dir
from ..operators import decontam, dedup, mix, normalize, quality, reasoning, render, split, validate
from ..sources import io
from ..sources.catalog import BENCHMARKS, SOURCES, Source, as_table
from .bindings import BUDGET, EXCLUSIVE, HARDEST, LICENSES, LONGEST, REPLAY, ROTATION, SEED, STAGE1, STAGE2, all_stages, conversation_records, document_records, items, lines, stage1, stage2, stage3, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# SQL fragments ---------------------------------------------------------------


def s_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[{WHITE}]+|[{WHITE}]+$', '', 'g')"


def s_parts(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, chr(10) || chr(10)), lambda p: {s_strip('p')}), lambda p: p <> '')"


def s_think(x: str) -> tuple[str, str]:
    closed, opened = f"regexp_matches({x}, '(?is)<think>.*?</think>')", f"regexp_matches({x}, '(?i)<think>')"
    inside = s_strip(f"regexp_extract({x}, '(?is)<think>(.*?)</think>', 1)")
    after = s_strip(f"regexp_extract({x}, '(?is)<think>.*?</think>(.*)', 1)")
    body = s_strip(f"regexp_extract({x}, '(?is)<think>(.*)', 1)")
    parts = s_parts(body)
    lead = f"array_to_string(({parts})[1:-2], chr(10) || chr(10))"
    return (
        f"CASE WHEN {closed} THEN nullif({inside}, '') WHEN {opened} THEN CASE WHEN len({parts}) > 1 THEN {lead} ELSE nullif({body}, '') END END",
        f"CASE WHEN {closed} THEN coalesce(nullif({after}, ''), {s_strip(x)}) WHEN {opened} THEN CASE WHEN len({parts}) > 1 THEN ({parts})[-1] ELSE {body} END ELSE {s_strip(x)} END",
    )


def s_plain(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


def s_rotate(x: str, values: tuple[str, ...]) -> str:
    return f"[{', '.join(repr(v) for v in values)}][{x} + 1]"


LINES = """l AS (SELECT doc_id, source, coalesce(text, '') AS body, split_part(coalesce(text, ''), chr(10), 1) AS usr,
    CASE WHEN strpos(coalesce(text, ''), chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE coalesce(text, '') END AS rest FROM documents)"""
_REASON, _ANSWER = s_think("raw")
DOC = f"""{LINES}, d1 AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN '<think>' || split_part(rest, chr(10), 1) || '</think>' || rest ELSE rest END AS raw FROM l),
d2 AS (SELECT *, {_REASON} AS reasoning, {_ANSWER} AS answer FROM d1),
doc AS (SELECT sha256(source || chr(0) || CAST(doc_id AS VARCHAR) || chr(0) || usr) AS id, source, source AS name, CAST(substr(source, 4) AS INTEGER) AS source_rank, doc_id AS idx,
    {s_rotate('doc_id % 5', ROTATION)} AS domain, usr, answer, reasoning, coalesce(length(reasoning), 0) > 0 AS reasoning_present,
    {s_rotate('CAST(substr(source, 4) AS INTEGER) % 4', LICENSES)} AS license, CAST(quality AS DOUBLE) AS pass_rate
    FROM d2 LEFT JOIN labels USING (doc_id) WHERE {s_strip('usr')} <> '' AND {s_strip('answer')} <> '')"""
_CR, _CA = s_think("text")
CONV = f"""t AS (SELECT conv_id, turn, CASE lower(role) WHEN 'tool' THEN 'user' ELSE lower(role) END AS role, text, {_CR} AS r, {_CA} AS a FROM conversations
    WHERE lower(role) IN ('user', 'assistant', 'system', 'tool') AND {s_strip("coalesce(text, '')")} <> ''),
c AS (SELECT conv_id, list(struct_pack(role := role, content := CASE WHEN role = 'assistant' THEN a ELSE text END, reasoning := CASE WHEN role = 'assistant' THEN r END) ORDER BY turn) AS m FROM t GROUP BY conv_id),
c2 AS (SELECT conv_id, m, coalesce(list_filter(m, lambda x: x.role = 'user')[1].content, '') AS usr FROM c),
conv AS (SELECT sha256('conversations' || chr(0) || CAST(conv_id AS VARCHAR) || chr(0) || usr) AS id, conv_id AS idx, m, usr,
    len(list_filter(m, lambda x: coalesce(length(x.reasoning), 0) > 0)) > 0 AS reasoning_present FROM c2
    WHERE {s_strip('usr')} <> '' AND len(list_filter(m, lambda x: x.role = 'assistant' AND {s_strip('x.content')} <> '')) > 0)"""
S_UNIT = "CAST(CAST(concat('0x', substr(sha256('42:' || id), 1, 16)) AS UBIGINT) AS DOUBLE) / 18446744073709551616.0"
S_LABEL = f"CASE WHEN NOT reasoning_present THEN 'off_nonreasoning' WHEN {S_UNIT} < 0.1 THEN 'off' WHEN {S_UNIT} < 0.14 THEN 'truncated' ELSE 'on' END"
S_WORDS = r"regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+')"


# records ---------------------------------------------------------------------


def _flat(messages, field: str):
    return F.array_join(F.transform(messages, lambda m: text(m[field])), "|")


@query(f"WITH {CONV} SELECT id, idx, 'chat' AS domain, CAST(len(m) AS INTEGER) AS n_messages, array_to_string(list_transform(m, lambda x: x.role), '|') AS roles, array_to_string(list_transform(m, lambda x: x.content), '|') AS contents, reasoning_present FROM conv")
def conv_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = conversation_records(spark, sf_dir)
    return r.select("id", "idx", "domain", F.size("messages").alias("n_messages"), _flat(F.col("messages"), "role").alias("roles"), _flat(F.col("messages"), "content").alias("contents"), "reasoning_present")


@query(f"WITH {CONV} SELECT id, idx FROM conv")
def conv_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_records(spark, sf_dir).select("id", "idx")


@query(f"WITH {DOC} SELECT id, source, name, source_rank, idx, domain, usr AS user_text, answer, reasoning, reasoning_present, license, pass_rate FROM doc")
def doc_instruct_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = document_records(spark, sf_dir)
    m = F.col("messages")
    return r.select("id", "source", "name", "source_rank", "idx", "domain", m[0]["content"].alias("user_text"), m[1]["content"].alias("answer"), m[1]["reasoning"].alias("reasoning"), "reasoning_present", "license", F.col("meta.pass_rate").alias("pass_rate"))


_V = {
    0: "'<think>' || usr || '</think> ' || rest", 1: "'<THINK></think>' || rest", 2: "'before <think>' || usr || '</think>'",
    3: "'<think>' || usr || chr(10) || chr(10) || rest", 4: "'<Think>' || usr", 5: "body",
}
_VR, _VA = s_think("v")


@query(f"WITH {LINES}, x AS (SELECT doc_id, CASE doc_id % 6 {' '.join(f'WHEN {k} THEN {v}' for k, v in _V.items())} END AS v FROM l) SELECT doc_id, {_VR} AS reasoning, {_VA} AS answer FROM x")
def split_think_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lines(table(spark, sf_dir, "documents")).withColumn("v", F.expr("CASE doc_id % 6 " + " ".join(f"WHEN {k} THEN {v}" for k, v in _V.items()) + " END"))
    return at.select("doc_id", think_parts(F.col("v")).alias("p")).select("doc_id", "p.reasoning", "p.answer")


_P = {0: "usr", 1: "usr", 2: "usr || ' {b}a{{b}}c} and {b}x_' || doc_id || '{{y}}}'", 3: "usr || chr(10) || chr(10) || rest", 4: "usr || ' {b}open'"}
_P = {k: v.replace("{b}", "\\boxed{").replace("{{", "{").replace("}}", "}") if k in (2, 4) else v for k, v in _P.items()}
_BOXED = s_strip(r"regexp_extract(list_extract(string_split(p, '\boxed{'), -1), '^((?:[^{}]|\{[^{}]*\})*)\}', 1)")


@query(
    rf"""WITH {LINES}, x AS (SELECT doc_id, {s_strip("CASE doc_id % 5 " + " ".join(f"WHEN {k} THEN {v}" for k, v in _P.items()) + " END")} AS p,
    CASE doc_id % 5 WHEN 1 THEN '42' END AS e FROM l),
    y AS (SELECT doc_id, p, coalesce(e, CASE WHEN contains(p, '\boxed{{') THEN nullif({_BOXED}, '') END) AS f, {s_parts('p')} AS parts FROM x)
    SELECT doc_id, CASE WHEN p = '' THEN NULL WHEN f IS NOT NULL THEN p WHEN len(parts) > 1 THEN array_to_string(parts[1:-2], chr(10) || chr(10)) END AS reasoning,
    CASE WHEN p = '' THEN '' WHEN f IS NOT NULL THEN 'The final answer is $\boxed{{' || f || '}}$.' WHEN len(parts) > 1 THEN parts[-1] ELSE p END AS answer FROM y"""
)
def split_prose_cot_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in _P.items()).replace("\\", "\\\\")
    at = lines(table(spark, sf_dir, "documents")).withColumn("p", F.expr(f"CASE doc_id % 5 {cases} END")).withColumn("e", F.expr("CASE doc_id % 5 WHEN 0 THEN 'Proof' WHEN 1 THEN '42' END"))
    return at.select("doc_id", prose_parts(F.col("p"), F.col("e")).alias("p")).select("doc_id", "p.reasoning", "p.answer")


@query(
    f"""WITH {LINES}, g AS (SELECT doc_id, body, string_split(body, chr(10))[1:3] AS gens, [doc_id % 4 = 1, doc_id % 3 = 0] AS ok FROM l)
    SELECT doc_id, coalesce(nullif(CASE WHEN ok[1] AND len(gens) >= 1 THEN gens[1] WHEN ok[2] AND len(gens) >= 2 THEN gens[2] END, ''), nullif(gens[1], ''), body) AS picked FROM g"""
)
def openr1_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lines(table(spark, sf_dir, "documents"))
    gens, ok = F.slice(F.split("body", "\n"), F.lit(1), F.lit(3)), F.array(F.col("doc_id") % 4 == 1, F.col("doc_id") % 3 == 0)
    return at.select("doc_id", normalize.pick_generation(gens, ok, F.col("body")).alias("picked"))


_RAW_ROLE = "CASE WHEN turn % 5 = 3 THEN 'observation' WHEN turn % 7 = 5 THEN 'critic' WHEN role = 'user' THEN 'Human' WHEN role = 'assistant' THEN 'GPT' ELSE role END"


@query(f"SELECT conv_id, turn, CASE lower({_RAW_ROLE}) WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'observation' THEN 'user' WHEN 'system' THEN 'system' WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'assistant' END AS resolved FROM conversations")
def sharegpt_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", normalize.lookup(normalize.FROM_ROLES, F.expr(_RAW_ROLE)).alias("resolved"))


@query("SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN 'n' || doc_id END, ''), CASE WHEN doc_id % 2 = 0 THEN 'u' || doc_id END, CAST(doc_id AS VARCHAR)) AS native FROM documents")
def native_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = table(spark, sf_dir, "documents").selectExpr("doc_id", "doc_id AS idx", "CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN 'n' || doc_id END AS id", "CASE WHEN doc_id % 2 = 0 THEN 'u' || doc_id END AS uuid")
    return at.select("doc_id", normalize.native_id(at).alias("native"))


@query(
    f"""WITH {LINES}, x AS (SELECT doc_id, usr, string_split(rest, chr(10)) AS tt, CASE WHEN doc_id % 2 = 0 THEN '' ELSE rest END AS attempt FROM l)
    SELECT sha256('traces' || chr(0) || CAST(doc_id AS VARCHAR) || chr(0) || usr) AS id, usr AS user_text, coalesce(nullif(attempt, ''), usr) AS answer, tt[1] AS reasoning FROM x
    WHERE {s_strip('usr')} <> '' AND {s_strip("coalesce(nullif(attempt, ''), usr)")} <> ''"""
)
def s1k_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lines(table(spark, sf_dir, "documents")).selectExpr("doc_id AS idx", "usr AS question", "split(rest, '\n') AS thinking_trajectories", "CASE WHEN doc_id % 2 = 0 THEN '' ELSE rest END AS attempt", "usr AS solution")
    source = Source("traces", "s1k", "reasoning", columns={"question": "question", "reasoning": "thinking_trajectories", "attempt": "attempt", "solution": "solution"})
    return _two(normalize.records(at, source))


@query(
    f"""WITH {LINES}, x AS (SELECT doc_id, usr, rest, CASE WHEN doc_id % 2 = 0 THEN '' ELSE usr END AS short FROM l)
    SELECT sha256('worked' || chr(0) || CAST(doc_id AS VARCHAR) || chr(0) || usr) AS id, usr AS user_text, coalesce(nullif(short, ''), nullif(rest, ''), '') AS answer, CASE WHEN short <> '' THEN nullif(rest, '') END AS reasoning FROM x
    WHERE {s_strip('usr')} <> '' AND {s_strip("coalesce(nullif(short, ''), nullif(rest, ''), '')")} <> ''"""
)
def limo_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lines(table(spark, sf_dir, "documents")).selectExpr("doc_id AS idx", "usr AS question", "rest AS solution", "CASE WHEN doc_id % 2 = 0 THEN '' ELSE usr END AS answer")
    return _two(normalize.records(at, Source("worked", "limo", "math", columns={"question": "question", "solution": "solution", "answer": "answer"})))


_OUT, _EXPECT, _RATE = "CASE WHEN doc_id % 3 = 0 THEN '<think>' || usr || '</think>' || rest ELSE rest END", "CASE WHEN doc_id % 5 = 1 THEN '42' END", "CASE doc_id % 4 WHEN 0 THEN '0.5' WHEN 1 THEN 'bad' END"
_IR, _IA = s_think("o")


@query(
    rf"""WITH {LINES}, x AS (SELECT doc_id, usr, {_OUT} AS o, {_EXPECT} AS e, {_RATE} AS rate FROM l), y AS (SELECT *, {s_strip('o')} AS p, {_IR} AS tr, {_IA} AS ta FROM x),
    z AS (SELECT *, {s_parts('p')} AS parts FROM y), w AS (SELECT *, CASE WHEN tr IS NOT NULL THEN tr WHEN p = '' THEN NULL WHEN e IS NOT NULL THEN p WHEN len(parts) > 1 THEN array_to_string(parts[1:-2], chr(10) || chr(10)) END AS reasoning,
    CASE WHEN tr IS NOT NULL THEN ta WHEN p = '' THEN '' WHEN e IS NOT NULL THEN 'The final answer is $\boxed{{' || e || '}}$.' WHEN len(parts) > 1 THEN parts[-1] ELSE p END AS answer FROM z)
    SELECT sha256('prose' || chr(0) || CAST(doc_id AS VARCHAR) || chr(0) || usr) AS id, usr AS user_text, answer, reasoning, e AS expected, TRY_CAST(rate AS DOUBLE) AS pass_rate FROM w WHERE {s_strip('usr')} <> '' AND {s_strip('answer')} <> ''"""
)
def instruct_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter of single turns, with plain-prose working."""
    at = lines(table(spark, sf_dir, "documents")).selectExpr("doc_id AS idx", "usr AS problem", f"{_OUT} AS solution", f"{_EXPECT} AS answer", f"{_RATE} AS rate")
    source = Source("prose", "instruct", "math", prose=True, columns={"instruction": "problem", "output": "solution", "answer": "answer", "pass_rate": "rate"})
    r = normalize.records(at, source)
    return _two(r, F.col("meta.expected_answer").alias("expected"), F.col("meta.pass_rate").alias("pass_rate"))


_GENS = "CASE WHEN doc_id % 2 = 0 THEN '<think>w</think>' || body ELSE body END"
_PR, _PA = s_think("picked")


@query(
    f"""WITH {LINES}, g AS (SELECT doc_id, usr, body, string_split({_GENS}, chr(10))[1:3] AS gens, [doc_id % 4 = 1, doc_id % 3 = 0] AS ok FROM l),
    k AS (SELECT doc_id, usr, coalesce(nullif(CASE WHEN ok[1] AND len(gens) >= 1 THEN gens[1] WHEN ok[2] AND len(gens) >= 2 THEN gens[2] END, ''), nullif(gens[1], ''), body) AS picked FROM g),
    a AS (SELECT doc_id, usr, {_PR} AS reasoning, coalesce(nullif({_PA}, ''), 'A' || doc_id) AS answer FROM k)
    SELECT sha256('many' || chr(0) || CAST(doc_id AS VARCHAR) || chr(0) || usr) AS id, usr AS user_text, answer, reasoning FROM a WHERE {s_strip('usr')} <> '' AND {s_strip('answer')} <> ''"""
)
def openr1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter of verified generations."""
    at = lines(table(spark, sf_dir, "documents")).withColumn("all", F.split(F.expr(_GENS), "\n"))
    at = at.select(F.col("doc_id").alias("idx"), F.col("usr").alias("problem"), F.slice("all", F.lit(1), F.lit(3)).alias("generations"), F.array(F.col("doc_id") % 4 == 1, F.col("doc_id") % 3 == 0).alias("correctness_math_verify"), F.col("body").alias("solution"), F.expr("'A' || doc_id").alias("answer"))
    return _two(normalize.records(at, Source("many", "openr1", "math", columns={"problem": "problem"})))


_SHARED = f"CASE lower({_RAW_ROLE}) WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'observation' THEN 'user' WHEN 'system' THEN 'system' WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'assistant' END"


@query(
    f"""WITH t AS (SELECT conv_id, turn, {_SHARED} AS role, text FROM conversations WHERE {_SHARED} IS NOT NULL AND {s_strip("coalesce(text, '')")} <> ''),
    c AS (SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS m FROM t GROUP BY conv_id), c2 AS (SELECT *, list_filter(m, lambda x: x.role = 'user')[1].content AS usr FROM c)
    SELECT sha256('shares' || chr(0) || CAST(conv_id AS VARCHAR) || chr(0) || usr) AS id, CASE conv_id % 3 WHEN 0 THEN 'code' ELSE 'tool' END AS domain, array_to_string(list_transform(m, lambda x: x.role), '|') AS roles,
    md5(array_to_string(list_transform(list_filter(m, lambda x: x.role = 'user'), lambda x: x.content), ' ')) AS users_md5 FROM c2 WHERE usr IS NOT NULL AND len(list_filter(m, lambda x: x.role = 'assistant')) > 0"""
)
def sharegpt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter of from/value turns, with a domain per row where it is known; and the users' text."""
    turns = table(spark, sf_dir, "conversations").withColumn("who", F.expr(_RAW_ROLE)).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("who").alias("from"), F.col("text").alias("value")))).alias("turns"))
    at = turns.selectExpr("conv_id AS idx", "turns", "CASE conv_id % 3 WHEN 0 THEN 'CODE' WHEN 1 THEN 'poetry' END AS topic")
    r = normalize.records(at, Source("shares", "sharegpt", "tool", columns={"conversations": "turns", "domain_field": "topic"}))
    return r.select("id", "domain", _flat(F.col("messages"), "role").alias("roles"), F.md5(render.user_text(F.col("messages"))).alias("users_md5"))


_PAIRS = """'[{"role":"user","content":"q' || turn || '"},{"role":"assistant"' || CASE conv_id % 3 WHEN 0 THEN ',"content":"a"' ELSE '' END || '},{"role":"user","content":' || CASE turn % 2 WHEN 0 THEN 'null' ELSE '"r"' END || '}]'"""


@query("SELECT conv_id, turn, CAST(CASE WHEN n > 1 THEN n ELSE 0 END AS INTEGER) AS n_turns FROM (SELECT conv_id, turn, 1 + CASE conv_id % 3 WHEN 0 THEN 1 ELSE 0 END + CASE turn % 2 WHEN 0 THEN 0 ELSE 1 END AS n FROM conversations)")
def chat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a JSON list that have both fields."""
    at = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(_PAIRS).alias("j"))
    return at.select("conv_id", "turn", F.size(normalize.clean_pairs(F.col("j"), "role", "content")).alias("n_turns"))


@query("SELECT doc_id, source, CAST(length(text) AS INTEGER) AS chars FROM documents")
def mirror_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's mirrored JSON lines, written in hash order and read in splits."""
    root = shared_dir(spark, "mirror")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    io.write_json_lines(docs, f"{io.mirror_path(root, 'docs')}/data.jsonl", [F.sha2(F.col("doc_id").cast("string"), 256)])
    return io.read_mirror(spark, root, "docs", docs.schema).select("doc_id", "source", F.length("text").alias("chars"))


@query("SELECT 'gsm8k' AS bench, text AS question FROM benchmark WHERE text <> ''")
def benchmark_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions of the benchmarks that are there; one that is missing does not stop the others."""
    root = shared_dir(spark, "benchmarks")
    table(spark, sf_dir, "benchmark").select(F.col("text").alias("question")).write.parquet(io.mirror_path(root, "gsm8k"))
    return io.read_benchmarks(spark, root, ["gsm8k", "aime", "unknown"], BENCHMARKS)[0]


@query("SELECT 'documents' AS name, 'ok' AS status, count(*) AS retained, 'doc_id,text' AS columns FROM documents UNION ALL SELECT 'missing', 'unavailable', 0, ''")
def acquire_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of acquired sources, one of which can't be read."""
    reads = {"documents": lambda: table(spark, sf_dir, "documents").select("doc_id", "text"), "missing": lambda: spark.read.parquet(f"{sf_dir}/none.parquet")}
    root = shared_dir(spark, "raw")
    rows = [(name, e["status"], e["retained"], ",".join(e["columns"])) for name, read in reads.items() for e in [io.acquire(read, f"{root}/{name}", wait=0)[1]]]
    return spark.createDataFrame(rows, "name string, status string, retained long, columns string")


def _two(records: DataFrame, *more) -> DataFrame:
    m = F.col("messages")
    return records.select("id", m[0]["content"].alias("user_text"), m[1]["content"].alias("answer"), m[1]["reasoning"].alias("reasoning"), *more)


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 10")
def row_cap_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of each source, as a capped scan takes them."""
    return io.first_rows(table(spark, sf_dir, "documents").select("doc_id", "source"), 10, "source", "doc_id")


# quality ---------------------------------------------------------------------

_LONGEST = 3_000
_OK = f"length(usr) <= {_LONGEST} AND length(answer) + coalesce(length(reasoning), 0) <= {_LONGEST} AND length(usr) - length(replace(usr, '�', '')) <= 3 AND length(answer || coalesce(reasoning, '')) - length(replace(answer || coalesce(reasoning, ''), '�', '')) <= 3 AND NOT (domain = 'code' AND (length(answer) - length(replace(answer, '```', ''))) / 3 % 2 <> 0)"


@query(f"WITH {DOC} SELECT id FROM doc WHERE {_OK}")
def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_filter(document_records(spark, sf_dir), max_chars=_LONGEST).select("id")


@query(f"WITH {DOC} SELECT name, count(*) AS rows_in, count(*) FILTER (WHERE {_OK}) AS rows_out, count(*) FILTER (WHERE {_OK}) / count(*) AS retention FROM doc GROUP BY name")
def quality_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.retention(document_records(spark, sf_dir), max_chars=_LONGEST)


_MARKED = "usr || '```' || repeat('�', CAST(doc_id % 6 AS INT)) || CASE WHEN doc_id % 2 = 0 THEN '``````' ELSE '````' END"


@query(f"WITH {LINES}, x AS (SELECT doc_id, {_MARKED} AS v FROM l) SELECT doc_id, CAST((length(v) - length(replace(v, '```', ''))) // 3 AS BIGINT) AS fences, CAST(length(v) - length(replace(v, '�', '')) AS BIGINT) AS replaced FROM x")
def fence_mojibake_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lines(table(spark, sf_dir, "documents")).withColumn("v", F.expr(_MARKED))
    return at.select("doc_id", count_of(F.col("v"), "```").alias("fences"), count_of(F.col("v"), "�").alias("replaced"))


# duplicates ------------------------------------------------------------------

_FIRST = ("src3", "src7")
_ORDERED = "SELECT doc_id, coalesce(text, '') AS text, lower(coalesce(text, '')) AS low, CASE WHEN source IN ('src3', 'src7') THEN 0 ELSE 1 END AS prio, CAST(substr(source, 4) AS INTEGER) AS source_rank FROM documents"
_ORDER = "prio, source_rank, doc_id"
_TOKENS = S_WORDS.format(x="low")
_SETS = f"""o AS ({_ORDERED}), k AS (SELECT *, md5(low) AS h, row_number() OVER (PARTITION BY md5(low) ORDER BY {_ORDER}) AS n FROM o),
f AS (SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS node FROM k WHERE n = 1),
w AS (SELECT node, doc_id, low, {_TOKENS} AS t FROM f),
s AS (SELECT node, doc_id, unnest(CASE WHEN len(t) >= 5 THEN list_distinct(list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' '))) WHEN low <> '' THEN [low] ELSE [] END) AS g FROM w)"""
_MINS = ", ".join(f"min(({a} * x + {b}) % 2147483647)" for a, b in dedup.permutations())
_SIGNED = f"{_SETS}, x AS (SELECT node, doc_id, (CAST(concat('0x', substr(md5(g), 1, 8)) AS BIGINT) >> 1) % 2147483647 AS x FROM s), m AS (SELECT node, doc_id, [{_MINS}] AS sig FROM x GROUP BY node, doc_id)"
_BANDED = f"{_SIGNED}, b AS (SELECT node, doc_id, unnest(list_transform(range(0, 5), lambda i: i || ':' || md5(array_to_string(sig[i * 11 + 1:i * 11 + 11], ',')))) AS bucket FROM m)"
_PAIRED = f"{_BANDED}, p AS (SELECT DISTINCT a.node AS a, c.node AS b, a.doc_id AS doc_a, c.doc_id AS doc_b FROM b a JOIN b c ON a.bucket = c.bucket AND a.node < c.node)"
_KEPT = f"""{_PAIRED}, q AS (SELECT b, list(a) AS low, row_number() OVER (ORDER BY b) AS rn FROM p GROUP BY b),
z AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS gone UNION ALL SELECT z.i + 1, CASE WHEN len(list_filter(q.low, lambda v: NOT list_contains(z.gone, v))) > 0 THEN list_append(z.gone, q.b) ELSE z.gone END FROM z JOIN q ON q.rn = z.i + 1),
e AS (SELECT unnest(gone) AS node FROM z WHERE i = (SELECT max(i) FROM z)),
v AS (SELECT k.doc_id, CASE WHEN e.node IS NOT NULL THEN 'near' WHEN k.n > 1 THEN 'exact' END AS dropped FROM k JOIN f ON f.h = k.h LEFT JOIN e ON e.node = f.node)"""


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text("text").alias("body"), F.when(F.col("source").isin(*_FIRST), 0).otherwise(1).alias("prio"), F.substring("source", 4, 10).cast("int").alias("source_rank"))


_BY = ["prio", "source_rank", "doc_id"]


@query(f"WITH o AS ({_ORDERED}) SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(low) ORDER BY {_ORDER}) AS n FROM o) WHERE n = 1")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = _bodies(spark, sf_dir).withColumn("_key", dedup.exact_key(F.col("body")))
    return dedup.first_of_each(at, ["_key"], _BY).select("doc_id")


@query(f"WITH o AS ({_ORDERED}), k AS (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(low) ORDER BY {_ORDER}) AS n FROM o) WHERE n = 1) SELECT doc_id, source, CAST(length(text) AS INTEGER) AS chars FROM documents SEMI JOIN k USING (doc_id)")
def dedup_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that deduplication keeps, whole."""
    kept = dedup.survivors(table(spark, sf_dir, "documents"), exact_dedup(spark, sf_dir), ["doc_id"])
    return kept.select("doc_id", "source", F.length("text").alias("chars"))


@query(f"WITH {_SETS} SELECT doc_id, count(*) AS n_shingles, min(g) AS least FROM s GROUP BY doc_id")
def shingle_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    # copies are counted too: counts are much narrower than texts, so no text is moved or sorted
    at = _bodies(spark, sf_dir).select(*_BY, dedup.exact_key(F.col("body")).alias("_key"), once(dedup.shingle_counts(F.col("body"))).alias("s"))
    first = dedup.first_of_each(at, ["_key"], _BY).filter("s.n > 0")
    return first.groupBy("doc_id").agg(F.sum("s.n").alias("n_shingles"), F.min("s.least").alias("least"))


def _signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(dedup.signed_firsts(_bodies(spark, sf_dir), F.col("body"), _BY, "sig").select(*_BY, "sig")).filter("sig IS NOT NULL")


@query(f"WITH {_SIGNED} SELECT doc_id, array_to_string(sig, ',') AS signature FROM m")
def minhash_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signed(spark, sf_dir).select("doc_id", F.array_join(F.transform("sig", lambda v: v.cast("string")), ",").alias("signature"))


@query(f"WITH {_PAIRED}, pp AS (SELECT a AS node, b AS other FROM p UNION ALL SELECT b, a FROM p) SELECT m.doc_id, count(other) AS n_partners FROM m LEFT JOIN pp USING (node) GROUP BY m.doc_id")
def lsh_partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per distinct text, how many others collide with it in a band."""
    members = cut(_signed(spark, sf_dir).select("doc_id", dedup.bands(F.col("sig")).alias("keys")))
    return dedup.partners(members, "doc_id", "keys")


@query(f"WITH RECURSIVE {_KEPT} SELECT doc_id FROM v WHERE dropped IS NULL")
def near_dedup_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicates(_bodies(spark, sf_dir), F.col("body"), _BY).filter("dropped IS NULL").select("doc_id")


@query(f"WITH RECURSIVE {_KEPT} SELECT count(*) AS total, count(*) FILTER (WHERE dropped = 'exact') AS dropped_exact, count(*) FILTER (WHERE dropped = 'near') AS dropped_near, count(*) FILTER (WHERE dropped IS NULL) AS kept FROM v")
def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("dropped")
    return dedup.near_duplicates(_bodies(spark, sf_dir), F.col("body"), _BY).agg(F.count("*").alias("total"), F.count_if(d == "exact").alias("dropped_exact"), F.count_if(d == "near").alias("dropped_near"), F.count_if(d.isNull()).alias("kept"))


# decontamination -------------------------------------------------------------


def s_grams(x: str) -> str:
    t = f"list_filter(string_split({s_plain(x)}, ' '), lambda q: q <> '')"
    return f"CASE WHEN len({t}) >= 8 THEN list_distinct(list_transform(range(1, len({t}) - 6), lambda i: array_to_string(({t})[i:i + 7], ' '))) WHEN len({t}) > 0 THEN [array_to_string({t}, ' ')] ELSE [] END"


_EVAL = f"ev AS (SELECT DISTINCT unnest(g) AS g FROM (SELECT {s_grams('text')} AS g FROM benchmark))"
_OVER = f"""{_EVAL}, dn AS (SELECT doc_id, source, list_filter(string_split({s_plain("coalesce(text, '')")}, ' '), lambda q: q <> '') AS t FROM documents),
dg AS (SELECT doc_id, source, CASE WHEN len(t) >= 8 THEN list_distinct(list_transform(range(1, len(t) - 6), lambda i: array_to_string(t[i:i + 7], ' '))) WHEN len(t) > 0 THEN [array_to_string(t, ' ')] ELSE [] END AS gs FROM dn),
du AS (SELECT doc_id, unnest(gs) AS g FROM dg), dh AS (SELECT doc_id, count(*) AS hit FROM du SEMI JOIN ev USING (g) GROUP BY doc_id),
ov AS (SELECT doc_id, source, CAST(len(gs) AS BIGINT) AS n_grams, coalesce(hit, 0) AS n_hit, CASE WHEN len(gs) > 0 THEN coalesce(hit, 0) / len(gs) ELSE 0 END AS overlap FROM dg LEFT JOIN dh USING (doc_id))"""
LOW = 0.2


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.eval_index(table(spark, sf_dir, "benchmark"))


def _over(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlap(table(spark, sf_dir, "documents"), "doc_id", F.col("text"), _index(spark, sf_dir))


@query(f"WITH {_EVAL} SELECT g AS gram FROM ev")
def eval_ngram_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir)


@query(f"WITH {_OVER} SELECT doc_id, n_grams, n_hit, overlap FROM ov")
def decontam_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over(spark, sf_dir)


@query(f"WITH {_OVER} SELECT doc_id FROM ov WHERE overlap < 0.6")
def decontam_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.clean(table(spark, sf_dir, "documents"), "doc_id", F.col("text"), _index(spark, sf_dir)).select("doc_id")


@query(f"WITH {_OVER} SELECT doc_id FROM ov WHERE overlap < {LOW}")
def decontam_keep_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.clean(table(spark, sf_dir, "documents"), "doc_id", F.col("text"), _index(spark, sf_dir), LOW).select("doc_id")


@query(f"WITH n AS (SELECT doc_id, {s_plain('text')} AS t FROM documents), q AS (SELECT DISTINCT {s_plain('text')} AS t FROM benchmark) SELECT DISTINCT doc_id FROM n JOIN q ON q.t <> '' AND contains(n.t, q.t)")
def decontam_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.holding(table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("text"), table(spark, sf_dir, "benchmark")).select("doc_id")


@query(f"WITH {_OVER} SELECT source, count(*) FILTER (WHERE overlap < {LOW}) AS kept, count(*) FILTER (WHERE overlap >= {LOW}) AS flagged FROM ov GROUP BY source")
def decontam_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _over(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return named.groupBy("source").agg(F.count_if(F.col("overlap") < LOW).alias("kept"), F.count_if(F.col("overlap") >= LOW).alias("flagged"))


@query(f"WITH {_OVER}, left_over AS (SELECT * FROM ov WHERE overlap < {LOW}), r AS (SELECT count(*) AS n_records, count(*) FILTER (WHERE overlap >= {LOW}) AS n_flagged FROM left_over) SELECT (SELECT count(*) FROM ev) AS n_eval, n_records, n_flagged, (SELECT count(*) FROM ev) > 0 AND n_records > 0 AND n_flagged = 0 AS passed FROM r")
def decontam_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate looks again at the output of the filter."""
    index = _index(spark, sf_dir)
    kept = decontam.clean(table(spark, sf_dir, "documents"), "doc_id", F.col("text"), index, LOW)
    return decontam.gate(kept, "doc_id", F.col("text"), index, LOW)


# reasoning -------------------------------------------------------------------


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_records(spark, sf_dir).withColumn("mode_label", reasoning.mode_label(F.col("id"), F.col("reasoning_present"), SEED))


@query(f"WITH {DOC} SELECT id, {S_UNIT} AS u, {S_LABEL} AS mode_label FROM doc")
def reasoning_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("id", unit_hash(SEED, F.col("id")).alias("u"), "mode_label")


@query(f"WITH {DOC} SELECT {S_LABEL} AS mode_label, count(*) AS n FROM doc GROUP BY 1")
def mode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).groupBy("mode_label").agg(F.count("*").alias("n"))


@query(f"WITH {DOC}, x AS (SELECT {S_LABEL} AS y FROM doc) SELECT count(*) FILTER (WHERE y <> 'off_nonreasoning') AS n_reasoning, count(*) FILTER (WHERE y = 'off') / count(*) FILTER (WHERE y <> 'off_nonreasoning') AS off_share, count(*) FILTER (WHERE y = 'truncated') / count(*) FILTER (WHERE y <> 'off_nonreasoning') AS truncated_share FROM x")
def mode_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.mode_shares(_labelled(spark, sf_dir))


@query(f"WITH {DOC} SELECT name, count(*) AS total, count(*) FILTER (WHERE reasoning_present) AS present, count(*) FILTER (WHERE reasoning_present) / count(*) AS rate FROM doc GROUP BY name")
def reasoning_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reasoning.rates(document_records(spark, sf_dir))


@query(f"WITH {DOC}, g AS (SELECT name, source_rank, count(*) AS total, count(*) FILTER (WHERE reasoning_present) / count(*) AS rate FROM doc GROUP BY name, source_rank) SELECT name, rate, round(rate, 3) >= 0.3 AS passed FROM g WHERE source_rank % 4 = 0")
def reasoning_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth source has to carry reasoning in three records of ten."""
    records = document_records(spark, sf_dir)
    catalog = records.select("name", (F.col("source_rank") % 4 == 0).alias("must_reason")).distinct()
    return reasoning.rate_gate(records, catalog, 0.3).select("name", "rate", "passed")


@query("SELECT doc_id, CASE WHEN length(text) > 600 THEN regexp_replace(substr(text, 1, 600), '(?s) [^ ]*$', '') ELSE text END AS clipped FROM documents")
def trace_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", reasoning.clip(F.col("text"), 600).alias("clipped"))


_CLIPPED = "CASE WHEN y = 'truncated' AND length(reasoning) > 200 THEN regexp_replace(substr(reasoning, 1, 200), '(?s) [^ ]*$', '') ELSE reasoning END"
_NL = "chr(10)"


def s_render(mode_on: str, reason: str, answer: str) -> str:
    return f"CASE WHEN {mode_on} AND coalesce(length({reason}), 0) > 0 THEN '<think>' || {_NL} || {reason} || {_NL} || '</think>' || {_NL} || {_NL} || {answer} ELSE '<think>' || {_NL} || {_NL} || '</think>' || {_NL} || {_NL} || {answer} END"


@query(
    f"""WITH {DOC}, {CONV}, x AS (SELECT id, usr, answer, reasoning, {S_LABEL} AS y FROM doc),
    a AS (SELECT id, y AS mode_label, CAST(2 AS INTEGER) AS n_turns, 'user: ' || usr || {_NL} || 'assistant: ' || {s_render("y IN ('on', 'truncated')", _CLIPPED, 'answer')} AS body FROM x),
    b AS (SELECT id, m, {S_LABEL} AS y FROM conv)
    SELECT * FROM a UNION ALL SELECT id, y, CAST(len(m) AS INTEGER), array_to_string(list_transform(m, lambda t: t.role || ': ' || CASE WHEN t.role = 'assistant' THEN {s_render("y IN ('on', 'truncated')", 't.reasoning', 't.content')} ELSE t.content END), {_NL}) FROM b"""
)
def render_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: documents and conversations as training rows, by reasoning mode."""
    records = document_records(spark, sf_dir).unionByName(conversation_records(spark, sf_dir))
    at = reasoning.assign(quality.quality_filter(records), SEED, chars=200)
    rows = at.select("id", "mode_label", render.conversations(F.col("messages"), F.col("meta.reasoning_mode")).alias("c"))
    return rows.select("id", "mode_label", F.size("c").alias("n_turns"), F.array_join(F.transform("c", lambda t: F.concat(t["from"], F.lit(": "), t["value"])), "\n").alias("body"))


# mix -------------------------------------------------------------------------

_RECORD_TEXT = "usr || '  ' || answer || ' ' || coalesce(reasoning, '')"
_ITEMS = f"{DOC}, it AS (SELECT name, idx, domain, source, source_rank, CAST(len({S_WORDS.format(x=_RECORD_TEXT)}) AS BIGINT) AS tokens, CAST(coalesce(length(reasoning), 0) AS BIGINT) AS rlen, pass_rate AS difficulty FROM doc)"


@query(f"WITH {DOC} SELECT id, CAST(len({S_WORDS.format(x=_RECORD_TEXT)}) AS BIGINT) AS tokens FROM doc")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_records(spark, sf_dir).select("id", F.size(words(render.record_text(F.col("messages")))).cast("long").alias("tokens"))


@query(f"WITH {_ITEMS} SELECT * FROM it")
def mix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrow index, written once: a mix reads it several times."""
    return cut(items(document_records(spark, sf_dir)))


def _names(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def s_sample(out: str, pool: str, group: str, key: str, targets: str) -> str:
    return f"""{out}_s AS (SELECT p.*, g.target, sum(tokens) OVER (PARTITION BY {group}) AS _all, coalesce(sum(tokens) OVER (PARTITION BY {group} ORDER BY {key} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before
    FROM {pool} p JOIN {targets} g USING ({group})), {out} AS (SELECT *, n AS pass FROM {out}_s, (SELECT unnest([0, 1, 2]) AS n) WHERE n * _all + _before < target)"""


def s_targets(ratios: dict[str, float], budget: float) -> str:
    return "(SELECT * FROM (VALUES " + ", ".join(f"('{d}', CAST({float(r * budget)!r} AS DOUBLE))" for d, r in ratios.items()) + ") v(domain, target))"


def s_key(salt: str, *names: str) -> str:
    return f"sha256(concat_ws(':', '{SEED}', '{salt}', {', '.join(names)}))"


_POOL = f"{_ITEMS}, pool AS (SELECT * FROM it WHERE source NOT IN ({_names(EXCLUSIVE)}))"
_S1 = f"{_POOL}, {s_sample('s1', 'pool', 'domain', s_key('stage1', 'name', 'idx'), s_targets(STAGE1, BUDGET['stage1']))}"
_S2 = f"""{_S1}, {s_sample('s2', 'pool', 'domain', s_key('stage2', 'name', 'idx'), s_targets(STAGE2, BUDGET['stage2'] * (1 - REPLAY)))},
rp AS (SELECT name, idx, domain, source, tokens, pass AS copy, 0 AS gg FROM s1), {s_sample('rr', 'rp', 'gg', s_key('replay', 'name', 'idx', 'copy'), f"(SELECT 0 AS gg, CAST({BUDGET['stage2'] * REPLAY!r} AS DOUBLE) AS target)")},
st2 AS (SELECT 'recipe' AS part, name, idx, domain, tokens, pass, CAST(NULL AS INTEGER) AS copy FROM s2 UNION ALL SELECT 'replay', name, idx, domain, tokens, pass, copy FROM rr)"""
_BEFORE = "coalesce(sum(tokens) OVER (ORDER BY {o} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
_S3 = f"""ex AS (SELECT * FROM it WHERE source IN ({_names(EXCLUSIVE)})), e0 AS (SELECT coalesce(sum(tokens), 0) AS e FROM ex),
hd AS (SELECT *, {_BEFORE.format(o='difficulty, source_rank, idx')} AS bf FROM it WHERE source IN ({_names(HARDEST)}) AND difficulty IS NOT NULL),
h1 AS (SELECT hd.* FROM hd, e0 WHERE e + bf < e + 0.5 * ({BUDGET['stage3']!r} - e)), e1 AS (SELECT e + coalesce((SELECT sum(tokens) FROM h1), 0) AS e FROM e0),
lg AS (SELECT *, {_BEFORE.format(o='rlen DESC, source_rank, idx')} AS bf FROM it WHERE source IN ({_names(LONGEST)})), l1 AS (SELECT lg.* FROM lg, e1 WHERE e + bf < {BUDGET['stage3']!r}),
st3 AS (SELECT 'exclusive' AS part, name, idx, domain, tokens FROM ex UNION ALL SELECT 'hardest', name, idx, domain, tokens FROM h1 UNION ALL SELECT 'longest', name, idx, domain, tokens FROM l1)"""
_ALL = f"{_S2}, {_S3}, al AS (SELECT 'stage1' AS stage, name, idx, domain, tokens FROM s1 UNION ALL SELECT 'stage2', name, idx, domain, tokens FROM st2 UNION ALL SELECT 'stage3', name, idx, domain, tokens FROM st3)"
_MIXED = "r AS (SELECT stage, domain, count(*) AS n_rows, count(DISTINCT (name, idx)) AS unique_rows, CAST(sum(tokens) AS BIGINT) AS tokens FROM al GROUP BY stage, domain), r2 AS (SELECT *, tokens / greatest(sum(tokens) OVER (PARTITION BY stage), 1) AS token_share FROM r)"


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrow index, written once: a mix reads it several times."""
    return cut(items(document_records(spark, sf_dir)))


@query(f"WITH {_S1} SELECT name, idx, domain, tokens, pass FROM s1")
def mix_stage1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage1(_items(spark, sf_dir)).select("name", "idx", "domain", "tokens", "pass")


@query(f"WITH {_S2} SELECT * FROM st2")
def mix_stage2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage2(_items(spark, sf_dir)).select("part", "name", "idx", "domain", "tokens", "pass", "copy")


@query(f"WITH {_ITEMS}, {_S3} SELECT * FROM st3")
def mix_stage3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage3(_items(spark, sf_dir)).select("part", "name", "idx", "domain", "tokens")


@query(f"WITH {_ALL}, {_MIXED} SELECT stage, domain, n_rows, unique_rows, tokens, token_share FROM r2")
def mix_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mixture_report(all_stages(_items(spark, sf_dir)))


@query(f"WITH {_ALL} SELECT stage, count(*) AS n_rows, count(DISTINCT (name, idx)) AS unique_rows, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) / greatest(count(DISTINCT (name, idx)), 1) AS upsample_factor FROM al GROUP BY stage")
def mix_stage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.stage_report(all_stages(_items(spark, sf_dir)))


_WANTED = ", ".join(f"('{s}', '{d}', CAST({r!r} AS DOUBLE))" for s, ratios in (("stage1", STAGE1), ("stage2", STAGE2)) for d, r in ratios.items())


@query(f"WITH {_ALL}, {_MIXED}, wa AS (SELECT * FROM (VALUES {_WANTED}) v(stage, domain, ratio)) SELECT wa.stage, wa.domain, ratio, coalesce(token_share, 0) AS token_share, abs(coalesce(token_share, 0) - ratio) <= 0.02 AS on_target FROM wa LEFT JOIN r2 ON r2.stage = wa.stage AND r2.domain = wa.domain")
def mix_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.fidelity(mix.mixture_report(all_stages(_items(spark, sf_dir))), {"stage1": STAGE1, "stage2": STAGE2})


@query(f"WITH {_S1} SELECT s1.name, s1.idx, pass, doc.id, length(doc.answer) AS answer_chars FROM s1 JOIN doc ON doc.name = s1.name AND doc.idx = s1.idx")
def mix_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payload of stage 1, a copy for each time a record was taken."""
    out = mix.gathered(stage1(_items(spark, sf_dir)), document_records(spark, sf_dir))
    return out.select("name", "idx", "pass", "id", F.length(F.col("messages")[1]["content"]).alias("answer_chars"))


# split, chunks, gates --------------------------------------------------------

_SIDES = f"{_S1}, ids AS (SELECT DISTINCT name || ':' || idx AS k FROM s1), rk AS (SELECT k, row_number() OVER (ORDER BY sha256('42:' || k)) AS rn, count(*) OVER () AS u FROM ids), te AS (SELECT k FROM rk WHERE rn <= greatest(1, CAST(floor(u * 0.05) AS BIGINT))), ro AS (SELECT name || ':' || idx AS k FROM s1)"


def _sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage1(_items(spark, sf_dir)).withColumn("k", F.concat_ws(":", "name", F.col("idx").cast("string")))
    return split.train_test(rows, "k", seed=SEED)


@query(f"WITH {_SIDES} SELECT 'train' AS side, k, count(*) AS copies FROM ro WHERE k NOT IN (SELECT k FROM te) GROUP BY k UNION ALL SELECT 'test', k, 1 FROM te")
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sides(spark, sf_dir).groupBy("side", "k").agg(F.count("*").alias("copies"))


@query(f"WITH {_SIDES}, tr AS (SELECT DISTINCT k FROM ro EXCEPT SELECT k FROM te) SELECT count(*) AS n_leaks FROM tr SEMI JOIN te USING (k)")
def split_leak_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.leaks(_sides(spark, sf_dir), "k").agg(F.count("*").alias("n_leaks"))


_CHUNK_ROWS = 100


@query(f"WITH {_S1} SELECT name, idx, pass, (row_number() OVER (ORDER BY {s_key('chunk', 'name', 'idx', 'pass')}) - 1) // {_CHUNK_ROWS} AS chunk FROM s1")
def chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage1(_items(spark, sf_dir)).withColumn("stage", F.lit("stage1")).withColumn("_key", mix.order_key(SEED, "chunk", "name", "idx", "pass"))
    return mix.chunked(rows, ["stage"], "_key", _CHUNK_ROWS).select("name", "idx", "pass", "chunk")


@query(
    f"""WITH {_S1}, ch AS (SELECT name || ':' || idx AS k, (row_number() OVER (ORDER BY {s_key('chunk', 'name', 'idx', 'pass')}) - 1) // {_CHUNK_ROWS} AS chunk FROM s1),
    u AS (SELECT chunk, k, row_number() OVER (PARTITION BY chunk ORDER BY sha256('42:' || k)) AS rn, count(*) OVER (PARTITION BY chunk) AS u FROM (SELECT DISTINCT chunk, k FROM ch)),
    te AS (SELECT chunk, k FROM u WHERE rn <= greatest(1, CAST(floor(u * 0.05) AS BIGINT)))
    SELECT chunk, 'test' AS side, k, CAST(1 AS BIGINT) AS copies FROM te UNION ALL SELECT chunk, 'train', k, count(*) FROM ch ANTI JOIN te USING (chunk, k) GROUP BY chunk, k"""
)
def chunk_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chunk with its own split, as the packaging writes them."""
    rows = stage1(_items(spark, sf_dir)).withColumn("stage", F.lit("stage1")).withColumn("_key", mix.order_key(SEED, "chunk", "name", "idx", "pass"))
    rows = mix.chunked(rows, ["stage"], "_key", _CHUNK_ROWS).withColumn("k", F.concat_ws(":", "name", F.col("idx").cast("string")))
    return split.train_test(rows, "k", ["stage", "chunk"], seed=SEED).groupBy("chunk", "side", "k").agg(F.count("*").alias("copies"))


def s_flag(flags: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower(license), '{x}')" for x in flags) + ")"


@query(f"WITH {DOC} SELECT name, license, count(*) AS n_rows, {s_flag(validate.CARD_FLAGS)} AS card_flag, {s_flag(validate.WIDE_FLAGS)} AS wide_flag FROM doc GROUP BY name, license")
def license_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = document_records(spark, sf_dir).groupBy("name", "license").agg(F.count("*").alias("n_rows"))
    return by.withColumn("card_flag", validate.flagged_license(F.col("license"))).withColumn("wide_flag", validate.flagged_license(F.col("license"), validate.WIDE_FLAGS))


@query(f"WITH {CONV} SELECT count(*) AS n_rows, count(*) FILTER (WHERE len(m) = 0) AS n_empty FROM conv")
def empty_row_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.emptiness(conversation_records(spark, sf_dir), "messages")


@query(f"SELECT doc_id, {s_strip('text')} AS stripped, {s_plain('text')} AS plain, lower(text) AS low, CAST(length(text) AS INTEGER) AS chars FROM documents")
def scalar_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", strip(F.col("text")).alias("stripped"), plain_ascii(F.col("text")).alias("plain"), F.lower("text").alias("low"), F.length("text").alias("chars"))


def _row(i, s) -> str:
    text = lambda v: "NULL" if v is None else f"'{v}'"
    name = s.id.replace("/", "__") + (f"__{s.config}" if s.config else "") + (f"__{s.split}" if s.split != "train" else "")
    return f"({i}, {text(s.id)}, '{name}', {text(s.domain)}, {text(s.license)}, {s.max_rows if s.max_rows else 'NULL'}, {str(s.gated).lower()})"


@query(f"SELECT * FROM (VALUES {', '.join(_row(i, s) for i, s in enumerate(SOURCES))}) v(source_rank, source, name, domain, license, max_rows, gated) WHERE NOT gated")
def source_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources that need no login."""
    return as_table(spark, SOURCES).filter(~F.col("gated")).select("source_rank", "source", "name", "domain", "license", "max_rows", "gated")
