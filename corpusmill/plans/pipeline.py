"""A pipeline from a YAML file: stages are checked and become one DataFrame plan, ending in exports."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import services
from ..functions import latex
from ..operators import chunking, cleaning, dedup, embedding, extraction, filters, metadata, perplexity, pii
from ..sources import files, sinks

#: Names that other documents use for the same stages.
ALIASES = {"deduplication": "duplication", "dedup": "duplication", "chunking": "chunker", "embedding": "qdrant_upload", "qdrant": "qdrant_upload", "perplexity_filter": "perplexity"}


@dataclass
class Run:
    """What a pipeline has done: its rows, lines that couldn't be read, and what was counted."""

    documents: DataFrame
    bad_lines: DataFrame | None = None
    observed: list[tuple[str, Observation]] = field(default_factory=list)

    @property
    def counts(self) -> list[dict]:
        """Rows that left each stage up to the last export or upload, and their share of the stage before in percent.

        They are counted by the job of the first export or upload after each stage, without a pass of their own.
        """
        out: list[dict] = []
        for name, o in self.observed:
            rows = o.get["rows"]
            before = out[-1]["rows"] if out else rows
            out.append({"stage": name, "rows": rows, "kept_percent": 100.0 * rows / before if before else 100.0, **{k: v for k, v in o.get.items() if k != "rows"}})
        return out


#: Stages that run a job of their own.
ACTING = ("export", "qdrant_upload")


def _options(config: dict, *names: str) -> dict:
    return {n: config[n] for n in names if n in config}


def _extraction(df: DataFrame, c: dict) -> DataFrame:
    if "bytes" not in df.columns:
        return filters.non_trivial(df)
    kind = c.get("format")
    return extraction.extract(df, None if kind in (None, "jsonl") else kind, services.pdf_service(c["url"]) if c.get("url") else None)


def _cleaning(df: DataFrame, c: dict) -> DataFrame:
    processors = [*cleaning.PROCESSORS, *(["latex"] if c.get("enable_latex_correction") else [])]
    out = cleaning.clean(df, processors, c.get("ocr_threshold", 0.99), c.get("min_words", 2))
    service = c.get("latex_service") or {}
    if c.get("enable_latex_correction") and service.get("url"):
        out = latex.correct(out, services.correction_service(service["url"], service.get("api_key", ""), service.get("model", "")))
        counts = [F.col(n) for n in ("latex_errors_found", "latex_corrections_made")]
        kept = [F.col("cleaning")[n].alias(n) for n in out.schema["cleaning"].dataType.names if n != "latex_errors_found"]
        out = out.withColumn("cleaning", F.struct(*kept, *counts)).drop("latex_errors_found", "latex_corrections_made")
    return out


def _pii(df: DataFrame, c: dict) -> DataFrame:
    if not c.get("url"):
        return pii.mask_pii(df, ("EMAIL_ADDRESS",))
    mask = services.masking_service(c["url"], c.get("entities", ("PERSON", "EMAIL_ADDRESS")), c.get("threshold", 0.35))
    masked = F.pandas_udf(lambda s: s.map(mask, na_action="ignore"), "string")
    out = df.withColumn("_masked", masked(F.col("content")))
    failed = F.col("content").isNotNull() & F.col("_masked").isNull()
    out = out.withColumns({"content": F.col("_masked"), "pii_error": F.when(failed, "the masking service failed")}).drop("_masked")
    good = F.length("content") > 1  # as non_trivial, but that a text which couldn't be masked stays as a null with its error
    return out.where(F.coalesce(good, F.lit(False)) | (F.col("pii_error").isNotNull() if c.get("on_error", "keep") == "keep" else F.lit(False)))


def _metadata(df: DataFrame, c: dict) -> DataFrame:
    out = metadata.extract_metadata(df, tuple(c.get("enabled_formats", metadata.FORMATS)), c.get("fallback_to_filename", True))
    if c.get("sidecars"):
        out = metadata.with_sidecars(out, metadata.read_sidecars(df.sparkSession, c["sidecars"]))
        if c.get("crossref_url"):
            out = metadata.with_bibliography(out, services.get_json(c["crossref_url"]))
    if c.get("export_metadata", True) and c.get("metadata_destination"):
        metadata.metadata_rows(out).write.mode("overwrite").json(f"{c['metadata_destination'].rstrip('/')}/{c.get('metadata_filename', 'metadata.jsonl')}")
    return out


def _perplexity(df: DataFrame, c: dict) -> DataFrame:
    scored = perplexity.model_perplexity(df, c["make_scorer"]) if c.get("make_scorer") else perplexity.unigram_perplexity(df)
    return perplexity.perplexity_filter(scored, c.get("threshold", 0.0), c.get("enable_threshold", c.get("enable_filter", False)))


def _upload(df: DataFrame, c: dict) -> DataFrame:
    e, store = c.get("embedder") or {}, c.get("vector_store") or {}
    embedder = services.remote_embedder(e["url"], e.get("model_name", ""), e.get("api_key", "EMPTY"), e.get("timeout", 300)) if e.get("url") else embedding.hashing_embedder(store.get("vector_size") or 64)
    if c.get("mode") == "local":
        return df if c.get("use_existing_embeddings") else embedding.embed(df, embedder, c.get("batch_size", 10))
    if not store.get("path"):
        raise ValueError("qdrant_upload needs vector_store.path, the folder of the table of points")
    named = df.withColumn("filename", F.element_at(F.split("file_path", "/"), -1))
    if not c.get("use_existing_embeddings"):
        named = embedding.embed(named.drop("embedding"), embedder)
    kept = [x for x in ("title", "headers", "year") if x in named.columns]
    if c.get("upload_pipeline_metadata"):
        measured = [x for x in ("word_count", "newline_count", "pii_tokens_percentage") if x in named.columns]
        named = named.withColumn("_measured", F.struct(*measured)) if measured else named
    embedding.upload(named, store["path"], use_existing_embeddings=True, metadata=kept, pipeline_metadata="_measured" if "_measured" in named.columns else None)
    return named.drop("filename", "_measured")


def _export(df: DataFrame, c: dict) -> DataFrame:
    sinks.export(df, c.get("output_dir") or c.get("destination") or "./output", c.get("format", "md"), c.get("mode", "overwrite"), c.get("json_quoted", False))
    if c.get("resume") and "source_key" in df.columns:
        sinks.mark_processed(df, f"{(c.get('output_dir') or c.get('destination')).rstrip('/')}/_processed")
    return df


STAGES: dict[str, Callable[[DataFrame, dict], DataFrame]] = {
    "extraction": _extraction,
    "duplication": lambda df, c: dedup.deduplicate(df, c.get("method", "exact"), **_options(c, "shingle_size", "num_perm", "threshold", "short_docs")),
    "cleaning": _cleaning,
    "pii": _pii,
    "metadata": _metadata,
    "chunker": lambda df, c: chunking.chunk_documents(df, **_options(c, "max_chunk_size", "chunk_overlap", "word_overlap", "add_headers", "merge_small_chunks", "headers_to_split_on", "unit")),
    "length_filter": lambda df, c: filters.length_filter(df, c.get("length"), c.get("comparison", "greater"), c.get("action", "keep")),
    "newline_filter": lambda df, c: filters.newline_filter(df, c.get("chunks"), c.get("comparison", "greater"), c.get("action", "keep")),
    "reference_filter": lambda df, c: filters.reference_filter(df, c.get("action", "discard")),
    "pii_filter": lambda df, c: filters.pii_filter(df, c.get("threshold"), c.get("action", "discard"), c.get("apply_filter", True)),
    "perplexity": _perplexity,
    "qdrant_upload": _upload,
    "export": _export,
}


def register(name: str, stage: Callable[[DataFrame, dict], DataFrame]) -> None:
    """Add a stage of one's own."""
    STAGES[name] = stage


def checked(stages: list) -> list[tuple[str, dict]]:
    """(name, config) of each stage, aliases resolved; unknown names fail."""
    out = []
    for s in stages:
        name = ALIASES.get(s["name"], s["name"])
        if name not in STAGES:
            raise ValueError(f"unknown stage {s['name']!r}; there are {', '.join(STAGES)}")
        out.append((name, dict(s.get("config") or {})))
    return out


def build(df: DataFrame, stages: list, observed: list | None = None) -> DataFrame:
    """The documents after all stages, in their order; exports and uploads run as they come.

    observed: gets (name, Observation) for the input and each stage before the last export or upload.
    """

    def counted(name: str, df: DataFrame) -> DataFrame:
        seen = Observation()
        observed.append((name, seen))
        totals = [F.count(F.lit(1)).alias("rows")]
        if name == "metadata" and "file_format" in df.columns:
            totals.append(F.count("extracted_metadata").alias("with_metadata"))
            totals += [F.count(F.when(F.col("file_format") == f, 1)).alias(f"{f}_rows") for f in metadata.FORMATS]
        if name == "cleaning" and "cleaning" in df.columns:
            totals += [F.sum(F.col("cleaning")[n]).alias(n) for n in df.schema["cleaning"].dataType.names if n.startswith(("duplicates_removed", "latex_errors", "latex_corr"))]
        return df.observe(seen, *totals)

    todo = checked(stages)
    last = max((i for i, (n, _) in enumerate(todo) if n in ACTING), default=-1)
    if observed is not None and last >= 0:
        df = counted("input", df)
    for i, (name, config) in enumerate(todo):
        df = STAGES[name](df, config)
        if observed is not None and i < last and name not in ACTING:
            df = counted(name, df)
    return df


def read_inputs(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(documents, bad lines): files with their bytes, JSON Lines with their content, Parquet folders as tables of texts."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    tables = [p for p in paths if p.rstrip("/").endswith(".parquet")]
    others = [p for p in paths if p not in tables]
    lines, bad = files.read_jsonl(spark, others)
    out = files.read_files(spark, others).unionByName(lines, allowMissingColumns=True)
    for p in files.present(spark, tables):
        out = out.unionByName(files.from_table(spark.read.parquet(p)).withColumn("doc_id", F.col("doc_id").cast("string")), allowMissingColumns=True)
    return out, bad


def run(spark: SparkSession, config: dict) -> Run:
    """Run a parsed configuration ``{"pipeline": {"inputs": {"path": ..}, "stages": [..]}}``.

    Extraction comes first where the stages don't begin with it, and an export ends them where there is none.
    """
    p = config["pipeline"]
    stages = checked(p.get("stages") or [])
    docs, bad = read_inputs(spark, p["inputs"]["path"])
    if not any(n == "extraction" for n, _ in stages):
        stages.insert(0, ("extraction", {}))
    if not any(n == "export" for n, _ in stages):
        stages.append(("export", {}))
    resume = next((c for n, c in stages if n == "export" and c.get("resume")), None)
    first = build(docs, [{"name": n, "config": c} for n, c in stages[:1]]) if stages[0][0] == "extraction" else docs
    if resume:
        first = sinks.unprocessed(sinks.with_source_key(first), f"{(resume.get('output_dir') or resume.get('destination')).rstrip('/')}/_processed")
    rest = stages[1:] if stages[0][0] == "extraction" else stages
    observed: list = []
    return Run(build(first, [{"name": n, "config": c} for n, c in rest], observed), bad, observed)


def load(path: str) -> dict:
    import yaml

    with open(path) as f:
        return yaml.safe_load(f)


def filter_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after, and the share that went in percent (0 without rows)."""
    rows = before.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(after.select(F.lit(0).alias("b"), F.lit(1).alias("a")))
    counted = rows.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("before"), F.coalesce(F.sum("a"), F.lit(0)).alias("after"))
    gone = F.when(F.col("before") > 0, (F.col("before") - F.col("after")) / F.col("before") * 100).otherwise(0.0)
    return counted.withColumn("removed_percent", gone.cast("double"))
