"""One dataset from source rows to published tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables import __version__
from regtables.functions.records import document_id
from regtables.operators.changes import changed_sources
from regtables.operators.quality import failures, invalid_values
from regtables.operators.sizing import is_small, pin, shuffles_released
from regtables.plans.specs import INGESTION_STATE, LOAD_MODES, RULE_VALUES, RUN_INPUTS, SOURCE_STATE, DatasetSpec, TableSpec
from regtables.sinks.log import Edit, Snapshot
from regtables.sinks.state import get_watermark, run_row, save_run, state_edit
from regtables.sinks.tables import Staged, bulk_load, commit, edit_of, ensure_tables, read_table, replaced_sources, resolved, stage


class LostInputError(ValueError):
    """An input could not be read; nothing was published."""


class ValidationError(ValueError):
    """Data broke its rules; nothing was published."""


def _side_by_side(spark: SparkSession, work: Callable, keys: Sequence[str]) -> dict:
    """``work`` of every table at once: their jobs do not depend on each other, and a small table
    need not wait for a large one."""
    if not keys:
        return {}
    with ThreadPoolExecutor(max_workers=len(keys)) as pool:
        return dict(zip(keys, pool.map(inheritable_thread_target(spark)(work), keys)))


def _one_by_one(spark: SparkSession, work: Callable, staged: Mapping[str, Staged]) -> dict:
    """``work`` of the small tables at once and then of each large one, which keeps all cores busy by itself, so that
    what large ones need on disk meanwhile does not add up."""
    small = [k for k, s in staged.items() if is_small(s.n_rows, s.key_bytes)]
    done = _side_by_side(spark, work, small)
    done |= {k: work(k) for k in staged if k not in done}
    return {k: done[k] for k in staged}


def _store_invalid_values(spark: SparkSession, spec: DatasetSpec, staged: Mapping[str, Staged], root: str) -> None:
    """Adds every value outside an allowed set to ``rule_values``; messages show only some of them."""
    ensure_tables(spark, spec.schema_name, [RULE_VALUES], root)
    for key, rows in staged.items():
        for rule in spec.tables[key].rules:
            if rule.get("check") == "is_in_set" and "allowed_values" in rule and rule.get("column") in rows.rows.columns:
                found = invalid_values(rows.rows, rule["column"], rule["allowed_values"]).select(
                    F.lit(spec.tables[key].name).alias("table_name"), F.lit(rule["column"]).alias("column_name"),
                    F.col("value").cast("string").alias("value"), "n_rows",
                )
                bulk_load(stage(found, RULE_VALUES, spec.schema_name, root), RULE_VALUES, spec.schema_name)


def _checked(spark: SparkSession, spec: DatasetSpec, frames: Mapping[str, DataFrame], root: str) -> dict[str, Staged]:
    """All tables staged, if none breaks a rule."""
    schema = spec.schema_name
    staged = _side_by_side(spark, lambda k: stage(frames[k], spec.tables[k], schema, root), list(frames))
    # The checks read the staged files: the plan that made them is not run again.
    full = [k for k, s in staged.items() if s.n_rows]
    found = _side_by_side(spark, lambda k: failures(staged[k].rows, spec.tables[k].all_rules), full)
    problems = [
        f"Data validation failed for table '{spec.tables[k].name}':\n" + "\n".join(messages)
        for k, messages in found.items()
        if messages
    ]
    if problems:
        _store_invalid_values(spark, spec, {k: staged[k] for k in full}, root)
        raise ValidationError("\n".join(problems))
    return staged


def load_tables(
    spark: SparkSession,
    spec: DatasetSpec,
    frames: Mapping[str, DataFrame],
    root: str,
    mode: str | None = None,
    on_duplicate: str = "error",
    run: DataFrame | None = None,
) -> dict[str, int]:
    """Stages every table, checks the rules of all, works out what each is to become, then publishes all by one
    commit, with the state of the ``run`` if there is one. Empty tables are skipped. Returns rows loaded per table."""
    mode = mode or spec.load_mode
    if mode not in LOAD_MODES:
        raise ValueError(f"load mode must be one of {LOAD_MODES}, not {mode!r}")
    schema = spec.schema_name
    with shuffles_released(spark):
        staged = {k: s for k, s in _checked(spark, spec, frames, root).items() if s.n_rows}
        loaded = {spec.tables[k].name: rows.n_rows for k, rows in staged.items()}
        if mode == "merge" and on_duplicate == "last":
            staged = _one_by_one(spark, lambda k: resolved(staged[k], spec.tables[k], schema, on_duplicate), staged)
        _publish(spark, spec, staged, root, mode, on_duplicate, run)
    return loaded


def _publish(
    spark: SparkSession, spec: DatasetSpec, staged: Mapping[str, Staged], root: str, mode: str, on_duplicate: str, run: DataFrame | None
) -> None:
    schema = spec.schema_name

    def edits(snapshot: Snapshot) -> dict[str, Edit]:
        edit = lambda k: edit_of(staged[k], spec.tables[k], schema, mode, snapshot.parts(spec.tables[k].name), on_duplicate=on_duplicate)
        made = {spec.tables[k].name: e for k, e in _one_by_one(spark, edit, staged).items()}
        return made | (state_edit(spark, schema, root, run, snapshot) if run is not None else {})

    changed = [spec.tables[k] for k in staged] + ([INGESTION_STATE] if run is not None else [])
    commit(spark, schema, root, changed, edits)


def _stored_account(spark: SparkSession, spec: DatasetSpec, inputs: DataFrame | None, root: str, as_of: datetime) -> int:
    """Adds the account of a run to ``run_inputs``; gives the number of unreadable inputs."""
    if inputs is None:
        return 0
    ensure_tables(spark, spec.schema_name, [RUN_INPUTS], root)
    rows = inputs.select(
        F.lit(spec.name).alias("dataset_id"), F.lit(as_of).alias("run_ts_utc"), "status", F.to_json(F.struct(*inputs.columns)).alias("input")
    )
    staged = stage(rows, RUN_INPUTS, spec.schema_name, root)
    bulk_load(staged, RUN_INPUTS, spec.schema_name)
    return staged.rows.where("status = 'unreadable'").count()


def run_dataset(
    spark: SparkSession,
    spec: DatasetSpec,
    build: Callable[[], Mapping[str, DataFrame]],
    root: str,
    as_of: datetime,
    watermark: Mapping | None = None,
    mode: str | None = None,
    on_duplicate: str = "error",
    pipeline_version: str = __version__,
    account: Callable[[], DataFrame] | None = None,
    allow_lost: bool = False,
) -> dict[str, int]:
    """Builds the tables of a dataset, loads them and records the run.

    Tables built from archives bring the account of their inputs along (:class:`Frames`), so no caller can leave it
    out; ``account`` gives one for others: a row per input with its ``status``. It is stored in the table
    ``run_inputs``. An input that is ``unreadable`` fails the run before anything is published. With
    ``allow_lost`` the others are loaded, but the old watermark stays, so the next run reads the source again.

    If ``watermark`` is what the last run stored, the source has not changed and nothing is built.
    A failed run is recorded as FAILED, keeps the last success and watermark, and raises.
    """
    ensure_tables(spark, spec.schema_name, [INGESTION_STATE, *spec.tables.values()], root)
    known = get_watermark(spark, spec.schema_name, spec.name)
    watermark = dict(watermark or {})

    def ended(status: str, token: Mapping) -> DataFrame:
        return run_row(spark, spec.name, as_of, status, token, pipeline_version)

    if watermark and watermark == known:
        save_run(spark, spec.schema_name, root, ended("SUCCESS", watermark))
        return {}
    try:
        with shuffles_released(spark):
            built = build()
        lost = _stored_account(spark, spec, account() if account else getattr(built, "account", None), root, as_of)
        if lost and not allow_lost:
            raise LostInputError(f"{lost} inputs of {spec.name} are unreadable, see {spec.schema_name}.run_inputs")
        return load_tables(spark, spec, built, root, mode, on_duplicate, ended("SUCCESS", known if lost else watermark))
    except Exception:
        save_run(spark, spec.schema_name, root, ended("FAILED", known))
        raise


def _of_sources(changed: DataFrame, table: TableSpec) -> DataFrame:
    """What tells the rows of these sources in a table: their url, or the document id made from it."""
    if "_meta_source_url" in table.columns:
        return changed.select(F.col("url").alias("_meta_source_url"))
    if "document_id" in table.columns:
        return changed.select(document_id(F.col("url")).alias("document_id"))
    raise ValueError(f"the rows of table '{table.name}' do not tell their source")


def run_sources(
    spark: SparkSession,
    spec: DatasetSpec,
    sources: DataFrame,
    build: Callable[[DataFrame], Mapping[str, DataFrame]],
    root: str,
    as_of: datetime,
    pipeline_version: str = __version__,
    allow_lost: bool = False,
) -> dict[str, int]:
    """Loads a dataset source by source: ``build`` gets only those ``sources`` (url, etag, last_modified; a row per url)
    that changed since they were loaded last, and their rows replace those they had in each table. Tables, the tokens of
    the sources and the run's state are published by one commit; a failed run leaves all sources as they were.

    Returns rows loaded per table; ``{}`` if no source changed. Unreadable inputs are as in :func:`run_dataset`: if
    they are allowed, no token is stored, so these sources are read again.
    """
    schema = spec.schema_name
    ensure_tables(spark, schema, [INGESTION_STATE, SOURCE_STATE, *spec.tables.values()], root)
    mark = get_watermark(spark, schema, spec.name)

    def ended(status: str) -> DataFrame:
        return run_row(spark, spec.name, as_of, status, mark, pipeline_version)

    try:
        known = read_table(spark, schema, SOURCE_STATE, root).where(F.col("dataset_id") == spec.name)
        changed = pin(changed_sources(sources.select("url", "etag", "last_modified"), known))
        if changed.isEmpty():
            save_run(spark, schema, root, ended("SUCCESS"))
            return {}
        built = build(changed)
        lost = _stored_account(spark, spec, getattr(built, "account", None), root, as_of)
        if lost and not allow_lost:
            raise LostInputError(f"{lost} inputs of {spec.name} are unreadable, see {schema}.run_inputs")
        staged = _checked(spark, spec, built, root)
        loaded = changed.select(F.lit(spec.name).alias("dataset_id"), "url", "etag", "last_modified", F.lit(as_of).alias("last_loaded_ts_utc"))
        tokens = stage(loaded.where(F.lit(not lost)), SOURCE_STATE, schema, root)

        def edits(snapshot: Snapshot) -> dict[str, Edit]:
            parts = lambda table: snapshot.parts(table.name)
            edit = lambda k: replaced_sources(staged[k], spec.tables[k], schema, parts(spec.tables[k]), _of_sources(changed, spec.tables[k]))
            made = {spec.tables[k].name: e for k, e in _side_by_side(spark, edit, list(staged)).items()}
            if tokens.n_rows:
                made[SOURCE_STATE.name] = edit_of(tokens, SOURCE_STATE, schema, "merge", parts(SOURCE_STATE))
            return made | state_edit(spark, schema, root, ended("SUCCESS"), snapshot)

        commit(spark, schema, root, [*(spec.tables[k] for k in staged), SOURCE_STATE, INGESTION_STATE], edits)
    except Exception:
        save_run(spark, schema, root, ended("FAILED"))
        raise
    return {spec.tables[k].name: s.n_rows for k, s in staged.items() if s.n_rows}
