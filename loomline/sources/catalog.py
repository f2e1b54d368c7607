"""The catalog of sources: a small dimension whose order is meaningful."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

KINDS = ("instruct", "messages", "sharegpt", "openr1", "s1k", "limo")
DOMAINS = ("math", "code", "science", "chat", "if", "tool", "safety", "multilingual", "reasoning")
ROLES = ("system", "user", "assistant")


@dataclass(frozen=True)
class Source:
    """One data set: where it comes from and which columns hold what."""

    id: str
    kind: str
    domain: str
    license: str = "unknown"
    config: str | None = None
    split: str = "train"
    max_rows: int | None = None
    columns: dict[str, str] = field(default_factory=dict, hash=False)
    gated: bool = False
    prose: bool = False
    trace: bool = False

    @property
    def name(self) -> str:
        """The partition key: id, config, and split unless it is "train"."""
        parts = [self.id.replace("/", "__"), self.config, self.split if self.split != "train" else None]
        return "__".join(p for p in parts if p)

    @property
    def must_reason(self) -> bool:
        """Whether its records have to carry reasoning."""
        return self.prose or self.trace or self.kind in ("openr1", "s1k", "limo")


def available(sources: list[Source]) -> list[Source]:
    return [s for s in sources if not s.gated]


def as_table(spark: SparkSession, sources: list[Source]) -> DataFrame:
    """The catalog as rows, with the rank that orders records of several sources."""
    rows = [(i, s.id, s.name, s.kind, s.domain, s.license, s.max_rows, s.gated, s.must_reason) for i, s in enumerate(sources)]
    return spark.createDataFrame(rows, "source_rank int, source string, name string, kind string, domain string, license string, max_rows int, gated boolean, must_reason boolean")


# The data sets of the default recipe, in the order that decides
# between equal records: id, kind, domain, licence, config, split, row cap.
_TABLE = (
    ("nvidia/OpenMathReasoning", "instruct", "math", "CC-BY-4.0", "default", "cot", 1_500_000),
    ("AI-MO/NuminaMath-1.5", "instruct", "math", "Apache-2.0", None, "train", 300_000),
    ("nvidia/OpenMathInstruct-2", "instruct", "math", "CC-BY-4.0", None, "train", 400_000),
    ("nvidia/Nemotron-Post-Training-Dataset-v2", "messages", "math", "CC-BY-4.0", "default", "math", 300_000),
    ("nvidia/Nemotron-Post-Training-Dataset-v2", "messages", "code", "CC-BY-4.0", "default", "code", 200_000),
    ("nvidia/Nemotron-Post-Training-Dataset-v2", "messages", "science", "CC-BY-4.0", "default", "stem", 150_000),
    ("nvidia/Nemotron-Post-Training-Dataset-v2", "messages", "chat", "CC-BY-4.0", "default", "chat", 150_000),
    ("open-thoughts/OpenThoughts3-1.2M", "sharegpt", "reasoning", "check-card", None, "train", 600_000),
    ("allenai/tulu-3-sft-mixture", "messages", "chat", "ODC-BY", None, "train", 500_000),
    ("allenai/tulu-3-sft-personas-instruction-following", "messages", "if", "ODC-BY", None, "train", None),
    ("nvidia/Nemotron-Instruction-Following-Chat-v1", "messages", "if", "ODC-BY", None, "chat_if", 100_000),
    ("nvidia/Nemotron-Instruction-Following-Chat-v1", "messages", "if", "CC-BY-4.0", None, "structured_outputs", 50_000),
    ("OpenCoder-LLM/opc-sft-stage2", "instruct", "code", "MIT", "educational_instruct", "train", 100_000),
    ("OpenCoder-LLM/opc-sft-stage2", "instruct", "code", "MIT", "evol_instruct", "train", 100_000),
    ("ise-uiuc/Magicoder-Evol-Instruct-110K", "instruct", "code", "check-card", None, "train", None),
    ("nvidia/OpenCodeReasoning", "instruct", "code", "CC-BY-4.0", "split_0", "split_0", None),
    ("nvidia/OpenCodeReasoning", "instruct", "code", "CC-BY-4.0", "split_1", "split_1", None),
    ("NousResearch/hermes-function-calling-v1", "sharegpt", "tool", "Apache-2.0", "func_calling", "train", None),
    ("allenai/SciRIFF", "instruct", "science", "ODC-BY", "4096", "train", 10_000),
    ("GAIR/LIMO", "limo", "math", "check-card", None, "train", None),
    ("simplescaling/s1K", "s1k", "reasoning", "check-card", None, "train", None),
)
# Columns by id, where they aren't those of the kind.
_COLUMNS = {
    "nvidia/OpenMathReasoning": {"instruction": "problem", "output": "generated_solution", "answer": "expected_answer", "pass_rate": "pass_rate_72b_tir"},
    "AI-MO/NuminaMath-1.5": {"instruction": "problem", "output": "solution", "answer": "answer"},
    "nvidia/OpenMathInstruct-2": {"instruction": "problem", "output": "generated_solution", "answer": "expected_answer"},
    "open-thoughts/OpenThoughts3-1.2M": {"conversations": "conversations", "domain_field": "domain"},
    "ise-uiuc/Magicoder-Evol-Instruct-110K": {"instruction": "instruction", "output": "response"},
    "nvidia/OpenCodeReasoning": {"instruction": "input", "output": "output", "answer": "solution"},
    "allenai/SciRIFF": {"instruction": "input", "output": "output"},
}
_BY_KIND = {
    "instruct": {"instruction": "instruction", "output": "output"},
    "messages": {"messages": "messages"},
    "sharegpt": {"conversations": "conversations"},
    "limo": {"question": "question", "solution": "solution", "answer": "answer"},
    "s1k": {"question": "question", "reasoning": "thinking_trajectories", "attempt": "attempt", "solution": "solution"},
}
# Sources behind a login; of plain-prose working; of native traces; first among equal records.
_GATED = ("nvidia/Nemotron-Post-Training-Dataset-v2",)
_PROSE = ("AI-MO/NuminaMath-1.5", "nvidia/OpenMathInstruct-2")
_TRACES = ("nvidia/OpenMathReasoning", "nvidia/OpenCodeReasoning")
FIRST = ("open-r1/OpenR1-Math-220k", "open-thoughts/OpenThoughts3-1.2M", "nvidia/Nemotron-Post-Training-Dataset-v2", "GAIR/LIMO", "simplescaling/s1K")
# The benchmarks' question columns by name: id, config, split, column.
BENCHMARKS = {
    "mmlu": ("cais/mmlu", "all", "test", "question"),
    "gsm8k": ("openai/gsm8k", "main", "test", "question"),
    "math": ("HuggingFaceH4/MATH-500", None, "test", "problem"),
    "gpqa": ("Idavidrein/gpqa", "gpqa_main", "train", "Question"),
    "ifeval": ("google/IFEval", None, "train", "prompt"),
    "aime": ("HuggingFaceH4/aime_2024", None, "train", "problem"),
}

SOURCES = [Source(*row, columns=_COLUMNS.get(row[0], _BY_KIND[row[1]]), gated=row[0] in _GATED, prose=row[0] in _PROSE, trace=row[0] in _TRACES) for row in _TABLE]
