"""JSON Lines, reports and configuration."""

from __future__ import annotations

import json
import os
import subprocess
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.sources import model

CORRUPT = "_corrupt"
UNKNOWN_COMMIT = "UNKNOWN_COMMIT"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """Rows of JSON Lines files. Blank lines are skipped, and lines that are no JSON objects; a missing path gives no rows.

    With keep_corrupt the lines that do not parse come back too, whole, in the column _corrupt.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    if not exists(spark, path):
        empty = spark.createDataFrame([], full)
        return empty if keep_corrupt else empty.drop(CORRUPT)
    # parsed line by line: the reader of JSON files refuses queries over its corrupt records alone
    lines = spark.read.text(path).where("trim(value) <> ''")
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.select(parsed.alias("r")).select("r.*")
    return rows if keep_corrupt else rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines files in a folder; null fields are left out. mode append adds one batch of rows as new files."""
    rows.write.mode(mode).option("ignoreNullFields", "true").json(path)


def write_version(rows: DataFrame, path: str) -> DataFrame:
    """Writes Parquet next to what is there and returns a DataFrame over it: a table is never read and overwritten at one path."""
    spark, n = rows.sparkSession, 0
    while exists(spark, f"{path}/v{n:04d}"):
        n += 1
    rows.write.parquet(f"{path}/v{n:04d}")
    return spark.read.schema(rows.schema).parquet(f"{path}/v{n:04d}")


def _local(path: str) -> str | None:
    """The path on the driver's disk; none for other file systems."""
    return path.removeprefix("file://") if "://" not in path or path.startswith("file://") else None


def _read(path: str) -> str | None:
    """A small file, on the driver's disk or any file system that Spark knows; none if it is missing."""
    if (here := _local(path)) is not None:
        if not os.path.exists(here):
            return None
        with open(here, encoding="utf-8") as f:
            return f.read()
    spark = SparkSession.active()
    return "".join(r[0] for r in spark.read.text(path, wholetext=True).collect()) if exists(spark, path) else None


def read_json(path: str) -> Any:
    text = _read(path)
    if text is None:
        raise FileNotFoundError(path)
    return json.loads(text)


def write_json(value: Any, path: str) -> None:
    """A report on the driver's disk, or on a file system that Spark knows; of a DataFrame every row is written."""
    here = _local(path)
    if here is None:
        rows = value.select(F.to_json(F.struct("*")).alias("value")).toLocalIterator() if isinstance(value, DataFrame) else None
        text = "[" + ",".join(r[0] for r in rows) + "]" if rows is not None else json.dumps(value, ensure_ascii=False, default=str)
        SparkSession.active().createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    os.makedirs(os.path.dirname(here) or ".", exist_ok=True)
    with open(here, "w", encoding="utf-8") as f:
        if not isinstance(value, DataFrame):
            json.dump(value, f, ensure_ascii=False, indent=2, default=str)
            return
        f.write("[")
        for i, row in enumerate(value.toLocalIterator()):
            f.write((",\n" if i else "\n") + json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str))
        f.write("\n]")


def load_config(path: str) -> dict[str, Any]:
    """A YAML or JSON file; an empty dict for a missing or empty one. YAML needs its library."""
    text = _read(path)
    if not text:
        return {}
    if path.endswith(".json"):
        return json.loads(text) or {}
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML files need PyYAML; write the configuration as JSON instead") from e
    return yaml.safe_load(text) or {}


def load_list(path: str, key: str) -> list[Any]:
    """The list under a key of a configuration file, or the file itself if it is a list."""
    found = load_config(path)
    value = found if isinstance(found, list) else found.get(key)
    return value if isinstance(value, list) else []


def setting(config: dict[str, Any], dotted: str, default: Any = None) -> Any:
    """config["a.b"] if there is such a key, else config["a"]["b"]; the default where a part is missing."""
    if dotted in config:
        return config[dotted]
    for part in dotted.split("."):
        if not isinstance(config, dict) or part not in config:
            return default
        config = config[part]
    return config


def limit_of(config: dict[str, Any], *names: str) -> int | None:
    """The smallest of several limits that are set to positive numbers; none if none is."""
    found = [int(v) for v in (setting(config, n) for n in names) if isinstance(v, (int, float)) and not isinstance(v, bool) and v > 0]
    return min(found) if found else None


def _typed(spark: SparkSession, path: str, schema: T.StructType, *needed: str) -> DataFrame:
    rows = read_jsonl(spark, path, schema)
    for c in needed:
        rows = rows.where(F.col(c).isNotNull())
    return rows


def load_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Symbols with all that a symbol must have; others are dropped."""
    rows = _typed(spark, path, model.SYMBOL, "symbol_id", "name", "qualified_name", "file_path", "source", "source_hash")
    return rows.where("symbol_type in ('class', 'method', 'field', 'file') and start_line >= 1 and end_line >= 1")


def load_samples(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark, path, model.SAMPLE)


def load_profiles(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark, path, model.PROFILE, "symbol_id", "qualified_name")


def load_chat(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    rows = _typed(spark, path, model.CHAT, "messages")
    return rows.limit(most) if most else rows


def user_questions(spark: SparkSession, path: str, commit: str = UNKNOWN_COMMIT) -> DataFrame:
    """Questions from a configuration file: texts, or objects with question, question_type, difficulty; blank ones are dropped."""
    rows = []
    for q in load_list(path, "questions"):
        q = {"question": q} if isinstance(q, str) else q if isinstance(q, dict) else {}
        if (q.get("question") or "").strip():
            rows.append((q["question"].strip(), q.get("question_type") or "how_to", q.get("difficulty") or "medium", commit))
    from sievework.functions.paths import question_id

    table = spark.createDataFrame(rows, "question string, question_type string, difficulty string, repo_commit string")
    return table.withColumn("question_id", question_id(F.col("question"), F.col("question_type")))


def design_questions(spark: SparkSession, path: str) -> DataFrame:
    """Design questions from a configuration file; those without a goal are dropped, missing ids are numbered."""
    rows = []
    for i, q in enumerate(load_list(path, "design_questions"), 1):
        if isinstance(q, dict) and (q.get("goal") or "").strip():
            listed = lambda k: [str(x) for x in (q.get(k) or [])]  # noqa: B023, E731
            rows.append((str(q.get("id") or f"DQ-{i:03d}"), q["goal"].strip(), listed("constraints"), listed("acceptance_criteria"), listed("non_goals"), q.get("question_type") or "architecture"))
    return spark.createDataFrame(rows, "id string, goal string, constraints array<string>, acceptance_criteria array<string>, non_goals array<string>, question_type string")


def constraints(path: str) -> list[str]:
    return [str(x) for x in load_list(path, "constraints")]


def repo_commit(configured: str | None, root: str) -> str:
    """The configured commit, else that of the working copy, else UNKNOWN_COMMIT."""
    if configured:
        return configured
    try:
        done = subprocess.run(["git", "-C", root, "rev-parse", "HEAD"], capture_output=True, text=True, timeout=10, check=False)
        return done.stdout.strip() or UNKNOWN_COMMIT if done.returncode == 0 else UNKNOWN_COMMIT
    except (OSError, subprocess.SubprocessError):
        return UNKNOWN_COMMIT


def parse_is_current(meta_path: str, commit: str) -> bool:
    """Whether the last parse saw this very commit; an unknown commit never counts as seen."""
    text = None if commit == UNKNOWN_COMMIT else _read(meta_path)
    return text is not None and json.loads(text).get("repo_commit") == commit
