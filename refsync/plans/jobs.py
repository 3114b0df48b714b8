"""The jobs: sync (increments or full files), integrate, classify, export. Each can be run alone.

Hand-over between jobs is through tables on shared storage. Only file names and summary rows reach the driver.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.config import FeedSpec, SyncSettings, TableSpec
from refsync.functions.keys import CleanKeys
from refsync.operators import audit, checks, classify as classifying, clean, feed, sync as syncing, tagging
from refsync.operators.skew import ROWS_PER_SLICE, HotKeys, stage_summarised
from refsync.sources import audit_store, check_store, files, outputs, snapshots, storage

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class SyncResult:
    """What a sync run did. The DataFrames read the tables the run wrote."""

    run_id: str
    kind: str
    snapshot: int
    files: list[str]
    tables: dict[str, str]
    counts: dict[str, int]
    checks: dict
    seconds: float
    waiting: int = 0  # files left for the next run


def _excluded(df: DataFrame, spec: TableSpec):
    """True or null for rows the exclusion rules drop."""
    rule = F.lit(False)
    if spec.excluded_accounts and spec.account in df.columns:
        rule = rule | F.col(f"`{spec.account}`").cast("string").isin(*spec.excluded_accounts)
    if spec.vendor_name in df.columns:
        for prefix in spec.excluded_vendor_prefixes:
            rule = rule | F.col(f"`{spec.vendor_name}`").startswith(prefix)
    return rule


def _exclude(df: DataFrame, spec: TableSpec) -> DataFrame:
    df = clean.exclude_values(df, spec.account, spec.excluded_accounts)
    if spec.vendor_name in df.columns:
        df = clean.exclude_prefix(df, spec.vendor_name, spec.excluded_vendor_prefixes)
    return df


def table_layout(spec: TableSpec, buckets: int | None) -> snapshots.Layout | None:
    """Buckets of the table by its key. The exclusion rules are part of it: under other rules all buckets are written."""
    rules = "|".join([*spec.excluded_accounts, "", *spec.excluded_vendor_prefixes])
    return None if buckets is None else snapshots.Layout(tuple(spec.keys), buckets, rules)


def _facts(rows: DataFrame, spec: TableSpec, weight: int = 1) -> DataFrame:
    return checks.check_facts(
        rows,
        spec.contract,
        spec.vendor,
        spec.catalogue,
        spec.item,
        spec.account,
        spec.sequence,
        spec.ignored_contract,
        spec.account_prefix_length,
        weight,
    )


def sync_increment(
    spark: SparkSession,
    table_root: str,
    audit_root: str,
    increments: DataFrame,
    spec: TableSpec = TableSpec(),
    file_names: list[str] | None = None,
    permitted: DataFrame | None = None,
    batch_id: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    file_states: Mapping[str, list] | None = None,
) -> SyncResult:
    """Apply cleaned increment rows (text, through `clean_strings`, with lineage columns) to the current snapshot.

    The typed increments are staged once, the tagged ones once; the table itself is read twice (rows that share
    a key, rows that do not) and written once. Of a table in buckets only those are read that increment keys fall into,
    and only those are written that accepted rows fall into (all of them if the exclusion rules changed). The manifest
    changes last: whatever fails before leaves the old snapshot current, and a repeated run starts over. If another
    writer commits meanwhile (to one of the buckets), this one fails. Without the version column no row is held to be
    outdated, and the last row of a key wins.
    """
    with storage.discard_staged(spark):
        return _sync_increment(
            spark, table_root, audit_root, increments, spec, file_names, permitted, batch_id, rows_per_slice, file_states
        )


def _sync_increment(
    spark, table_root, audit_root, increments, spec, file_names, permitted, batch_id, rows_per_slice, file_states
) -> SyncResult:
    started = time.monotonic()
    keys, version = list(spec.keys), spec.version
    clean.require_columns(increments, keys)
    gate = version in increments.columns
    if not gate:
        log.warning("no column %s: outdated rows are not recognised", version)
        increments = increments.withColumn(version, F.lit(None).cast("string"))
    base = snapshots.sequence(spark, table_root)
    state = snapshots.state(spark, table_root)
    if state is None:
        raise ValueError(f"no snapshot in {table_root}")
    with storage.discard_staged(spark):
        typed = storage.stage(clean.enforce_schema(increments, spec.types), "increments")
        layout = table_layout(spec, state.layout and state.layout.buckets)
        same_rules = layout == state.layout
        met = snapshots.buckets_of(typed, layout) if layout and same_rules else None
        current = snapshots.read_snapshot(spark, table_root, buckets=met)
        clean.require_columns(current, keys)
        increment_rows, table_rows = typed.count(), current.count()  # both from Parquet footers
        few = tagging.few_keys(increment_rows, table_rows)
        # many keys: the search for a key's latest row deals the whole table by key anyway
        touched = tagging.touched_rows(current, typed, keys, few, True, rows_per_slice, table_rows) if few else current
        marked = tagging.tag_increments(
            touched, typed, keys, version, _excluded(typed, spec), True, rows_per_slice=rows_per_slice, gate=gate, rows=increment_rows
        )
        tagged = storage.stage(marked, "tagged", outer=True)  # the typed rows are not read after this
    accepted = tagging.accepted_rows(tagged)
    clean_keys = CleanKeys(keys)
    winners = storage.stage(syncing.latest_wins(accepted, clean_keys, version).drop(*syncing.LINEAGE), "winners")
    written_buckets = snapshots.buckets_of(winners, layout) if layout and same_rules else None
    replaced = current if written_buckets is None else snapshots.read_snapshot(spark, table_root, buckets=written_buckets)
    # the rows that stay and (for the facts) those that go are told by two joins of the same table
    heavy = None if few or table_rows <= rows_per_slice else tagging.heavy_table_keys(replaced, keys, rows_per_slice)
    kept = tagging.untouched_rows(replaced, winners, keys, few, True, rows_per_slice, table_rows, heavy)
    updated = _exclude(kept.unionByName(winners, allowMissingColumns=True), spec)
    if layout is None:
        part = snapshot = snapshots.write_data(updated, table_root)
        written = spark.read.parquet(snapshots.snapshot_path(table_root, snapshot))
    else:
        part = snapshots.write_buckets(updated, table_root, layout, written_buckets)
        snapshot = part.snapshot
        written = snapshots.read_part(spark, table_root, part, state)

    # A replayed batch gets the same run id, so its audit tables are written over, not added twice.
    run_id = uuid.uuid5(uuid.NAMESPACE_URL, batch_id).hex if batch_id else f"{snapshot:06d}-{uuid.uuid4().hex[:8]}"
    has_source = spec.source_file if spec.source_file in typed.columns else None
    tables = {
        "rows_by_date": audit.rows_by_date(accepted, version, has_source),
        "new_rows": tagged.filter(F.col("status") == "new").drop("__previous", "status", *syncing.LINEAGE),
        "field_changes": tagging.tagged_changes(tagged, keys, version),
        "duplicate_versions": syncing.duplicate_versions(accepted, clean_keys, rows_per_slice, increment_rows),
        "table_duplicate_keys": checks.table_duplicate_keys(current, winners, keys),
        "stale_rows": tagged.filter(F.col("status") == "stale").drop("__previous", "status"),
    }
    if layout is None:
        fact_part = None
        tables["issues"] = checks.issue_rows(_facts(written, spec), permitted, spec.item)
    else:
        facts_root = f"{audit_root}/check_facts"
        facts_base = snapshots.sequence(spark, facts_root)
        if same_rules and check_store.is_current(spark, facts_root, state.snapshot):
            gone = tagging.touched_rows(replaced, winners, keys, few, True, rows_per_slice, table_rows, heavy)
            change = _facts(winners, spec).unionByName(_facts(gone, spec, -1))
            fact_part = check_store.prepare(spark, facts_root, storage.stage(change, "fact-changes"))
        else:
            fact_part = check_store.prepare_all(_facts(written, spec), facts_root)
        tables["issues"] = check_store.issues(spark, facts_root, fact_part)
    if permitted is not None and {spec.catalogue, spec.item} <= set(written.columns):
        tables["permitted_blanks"] = checks.permitted_blanks(written, spec.catalogue, spec.item, permitted)
    if file_states:
        tables["source_files"] = audit_store.file_rows(spark, "increment", **file_states)
    if has_source:
        tables["per_file_summary"] = audit.per_file_summary(tagged, spec.source_file, version)
        tables["run_summary"] = audit.run_summary(tagged, spec.source_file)
    paths = audit_store.write_audit(tables, audit_root, run_id)
    # All rows of the repeated keys and all changes are there now; their summaries read only those.
    repeated = spark.read.parquet(paths["duplicate_versions"])
    summaries = {
        "changes_by_column": syncing.changes_by_column(spark.read.parquet(paths["field_changes"])),
        "duplicate_keys": syncing.duplicate_keys(repeated, clean_keys, version, spec.price, has_source),
        "duplicate_history": syncing.duplicate_history(repeated, clean_keys, version, spec.price),
    }
    paths |= audit_store.write_audit(summaries, audit_root, run_id)
    counts = {r["status"]: r["count"] for r in tagged.groupBy("status").count().collect()}
    if fact_part is None:
        found = checks.issue_counts(spark.read.parquet(paths["issues"])).first().asDict()
    else:
        found = check_store.counts(spark, facts_root, fact_part, permitted, spec.item)
    seconds = time.monotonic() - started
    row_count = written.count() if layout is None else sum(part.rows.values()) + sum(
        own[1] for b, own in state.folders.items() if same_rules and b not in set(part.touched)
    )
    # the run is recorded before it counts: a replay after a crash between the two writes the same row again
    audit_store.record_run(
        spark,
        audit_root,
        run_id=run_id,
        kind="increment",
        seconds=seconds,
        files=file_names or [],
        snapshot=snapshot,
        row_count=row_count,
        column_count=len(written.columns),
        new_rows=counts.get("new", 0),
        updated_rows=counts.get("updated", 0),
        skipped_rows=counts.get("stale", 0),
        **found,
    )
    snapshots.commit(spark, table_root, part, batch_id, run_id, base)
    if fact_part is not None:
        check_store.commit(spark, facts_root, fact_part, snapshot, facts_base)
    return SyncResult(run_id, "increment", snapshot, file_names or [], paths, counts, found, seconds)


def full_refresh(
    spark: SparkSession,
    table_root: str,
    audit_root: str,
    rows: DataFrame,
    spec: TableSpec = TableSpec(),
    file_names: list[str] | None = None,
    permitted: DataFrame | None = None,
    dedup: bool = False,
    file_states: Mapping[str, list] | None = None,
    buckets: int | None = None,
) -> SyncResult:
    """Replace the table by the rows of full files, dealt into `buckets` if given. The snapshot before stays as the backup.

    The typed rows are staged: the files are read and their text is parsed once.
    """
    with storage.discard_staged(spark):
        return _full_refresh(spark, table_root, audit_root, rows, spec, file_names, permitted, dedup, file_states, buckets)


def _full_refresh(spark, table_root, audit_root, rows, spec, file_names, permitted, dedup, file_states, buckets) -> SyncResult:
    started = time.monotonic()
    base = snapshots.sequence(spark, table_root)
    clean_rows = storage.stage(clean.enforce_schema(rows, spec.types), "full-rows")
    table = _exclude(clean_rows, spec)
    if dedup and spec.version in table.columns:
        table = syncing.latest_wins(table, list(spec.keys), spec.version)
    elif dedup:
        undated = table.withColumn(spec.version, F.lit(None).cast("date"))
        table = syncing.latest_wins(undated, list(spec.keys), spec.version).drop(spec.version)
    layout = table_layout(spec, buckets)
    kept = table.drop(*syncing.LINEAGE)
    part = snapshots.write_data(kept, table_root) if layout is None else snapshots.write_buckets(kept, table_root, layout)
    snapshot = part if layout is None else part.snapshot
    written = snapshots.read_snapshot(spark, table_root, snapshot)
    run_id = f"{snapshot:06d}-{uuid.uuid4().hex[:8]}"
    tables = {"table_duplicate_keys": checks.table_duplicate_keys(written, written.limit(0), list(spec.keys))}
    if spec.version in clean_rows.columns:
        source = spec.source_file if spec.source_file in clean_rows.columns else None
        tables["rows_by_date"] = audit.rows_by_date(clean_rows, spec.version, source)
        tables["duplicate_keys"] = syncing.duplicate_keys(clean_rows, list(spec.keys), spec.version, spec.price, source)
    if permitted is not None and {spec.catalogue, spec.item} <= set(written.columns):
        tables["permitted_blanks"] = checks.permitted_blanks(written, spec.catalogue, spec.item, permitted)
    if layout is None:
        fact_part = None
        tables["issues"] = checks.issue_rows(_facts(written, spec), permitted, spec.item)
    else:
        facts_root = f"{audit_root}/check_facts"
        facts_base = snapshots.sequence(spark, facts_root)
        fact_part = check_store.prepare_all(_facts(written, spec), facts_root)
        tables["issues"] = check_store.issues(spark, facts_root, fact_part)
    if file_states:
        tables["source_files"] = audit_store.file_rows(spark, "full", **file_states)
    paths = audit_store.write_audit(tables, audit_root, run_id)
    if fact_part is None:
        found = checks.issue_counts(spark.read.parquet(paths["issues"])).first().asDict()
    else:
        found = check_store.counts(spark, facts_root, fact_part, permitted, spec.item)
    row_count = written.count()
    seconds = time.monotonic() - started
    audit_store.record_run(
        spark,
        audit_root,
        run_id=run_id,
        kind="full",
        seconds=seconds,
        files=file_names or [],
        snapshot=snapshot,
        row_count=row_count,
        column_count=len(written.columns),
        **found,
    )
    snapshots.commit(spark, table_root, part, None, run_id, base)
    if fact_part is not None:
        check_store.commit(spark, facts_root, fact_part, snapshot, facts_base)
    return SyncResult(run_id, "full", snapshot, file_names or [], paths, {}, found, seconds)


def sync(
    spark: SparkSession,
    folder: str,
    table_root: str,
    audit_root: str,
    spec: TableSpec = TableSpec(),
    settings: SyncSettings = SyncSettings(),
    permitted: DataFrame | None = None,
) -> SyncResult | None:
    """Full files if there are new ones, else the oldest increments that were not applied yet, else nothing."""

    options = {"on_error": settings.on_error, "on_bad_rows": settings.on_bad_rows, "multi_line": settings.multi_line}

    def states(found: files.Files) -> dict[str, list]:
        unreadable = [{"path": p, "name": p.rsplit("/", 1)[-1], "modified": None, "length": None} for p in found.unreadable]
        return {"applied": found.chosen, "superseded": found.superseded, "unreadable": unreadable}

    def names(found: files.Files) -> list[str]:
        return [f["name"] for f in found.chosen]

    done = audit_store.applied_files(spark, table_root, audit_root)
    found = files.read_increments(
        spark,
        folder,
        settings.file_format,
        settings.full_glob,
        newest_only=settings.keep_only_latest_full,
        applied=done,
        **options,
    )
    if found.rows is not None:
        result = full_refresh(
            spark,
            table_root,
            audit_root,
            found.rows,
            spec,
            names(found),
            permitted,
            settings.full_refresh_dedup,
            states(found),
            settings.buckets,
        )
    else:
        found = files.read_increments(
            spark,
            folder,
            settings.file_format,
            settings.increment_glob,
            exclude_glob=settings.full_glob,
            max_files=settings.max_files,
            applied=done,
            **options,
        )
        if found.rows is None:
            return None
        result = sync_increment(
            spark, table_root, audit_root, found.rows, spec, names(found), permitted, file_states=states(found)
        )
    if found.waiting:
        log.info("%s files wait for the next run", found.waiting)
    if settings.archive_folder:
        storage.archive_files(spark, [f["path"] for f in [*found.chosen, *found.superseded]], settings.archive_folder)
    snapshots.expire_snapshots(spark, table_root, settings.retention_days)
    return replace(result, waiting=found.waiting)


def report(spark: SparkSession, audit_root: str, result: SyncResult) -> str:
    """Text report of a run, from its summary tables (a few rows per file)."""
    summary, per_file = [], []
    if "run_summary" in result.tables:
        summary = [r.asDict() for r in spark.read.parquet(result.tables["run_summary"]).collect()]
        files_table = spark.read.parquet(result.tables["per_file_summary"])
        per_file = [r.asDict() for r in files_table.orderBy(files_table.columns[0]).collect()]
    return audit.render_markdown(summary, per_file, result.checks, result.seconds)


def prepare_baseline(table: DataFrame, spec: TableSpec = TableSpec()) -> DataFrame:
    """Table rows the feed is matched against: filters, mirrors, distinct, account prefix, prefixed names.

    The two prefix filters and the column selection reach the Parquet scan. Mirrors are removed before the
    distinct (copies do not change which rows have a twin), so the search for twins reads three columns.
    """
    rows = clean.exclude_prefix(table, spec.item, spec.baseline_item_prefix)
    rows = clean.exclude_prefix(rows, spec.vendor_name, spec.baseline_vendor_prefix)
    rows = rows.drop(*[c for c in spec.baseline_drop if c in rows.columns])
    rows = feed.suppress_mirrors(
        rows, [spec.item, spec.catalogue], spec.account, spec.mirror_accounts, spec.secondary_accounts
    ).distinct()
    prefix = feed.account_prefix(spec.account, spec.account_prefix_length).alias("Corp_Acct_Prefix")
    return clean.prefix_columns(rows.select("*", prefix), spec.baseline_prefix)


def baseline_lookups(base: DataFrame, spec: TableSpec = TableSpec()) -> feed.Lookups:
    """The six lookup tables of a prepared baseline."""
    p = spec.baseline_prefix
    return feed.build_lookups(
        base,
        item=p + spec.item,
        catalogue=p + spec.catalogue,
        manufacturer_catalogue=p + spec.manufacturer_catalogue,
        description=p + spec.description,
        prefix=p + "Corp_Acct_Prefix",
        sequence=p + spec.sequence,
        vendor=p + spec.vendor,
        contract_columns=[
            p + c
            for c in (spec.contract, spec.effective, spec.expiry, spec.contract_flag, spec.vendor, spec.vendor_name)
        ],
        contract_flag=p + spec.contract_flag,
        list_name=p + "Vendors List",
    )


def integrate(
    daily: DataFrame,
    table: DataFrame,
    manufacturer_map: DataFrame,
    vendor_map: DataFrame,
    spec: TableSpec = TableSpec(),
    roles: FeedSpec = FeedSpec(),
    legacy_null_join: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Daily feed rows with their candidates, vendor details, date check, mapped codes, price and duplicate flag.

    The baseline, the feed, the candidates (narrow) and the mapped rows are staged, of which only the last are left. Row counts
    and frequent keys are found while they are written, so building a join starts no count of its own side. Run it and the
    write of its result inside `storage.discard_staged` to have the mapped rows deleted.
    """
    row_keys = [roles.source, roles.index]
    with storage.discard_staged(table.sparkSession):
        base, of_base = stage_summarised(prepare_baseline(table, spec), "baseline")
        lookups = baseline_lookups(base, spec)
        parts = ([roles.distributor_part], [roles.manufacturer_part])
        codes = ([roles.manufacturer_code], [roles.vendor_code])
        daily, of_daily = stage_summarised(daily, "daily", *parts, *codes)
        routes = {
            "DPN": (roles.distributor_part, lookups.by_distributor_part),
            "MPN": (roles.manufacturer_part, lookups.by_manufacturer_part),
        }
        found, of_found = stage_summarised(
            feed.match_candidates(daily, routes, row_keys, rows_per_slice, of_daily, of_base.rows), "candidates", ["candidate"]
        )
        collapsed = feed.collapse_candidates(
            daily, found, row_keys, roles.candidate, roles.candidate_source, legacy_null_join, rows_per_slice, of_found.rows
        )
        heavy = of_found.hot(found, ["candidate"], rows_per_slice)
        if of_daily.rows > rows_per_slice:
            heavy = None  # feed rows without a candidate share a blank one, which may be heavy: count
        enriched = feed.enrich(
            collapsed,
            lookups,
            roles.candidate,
            roles.plant,
            roles.distributor,
            spec.account_prefix_length,
            rows_per_slice,
            None if heavy is None else HotKeys((roles.candidate,), None if heavy.table is None else heavy.table.toDF(roles.candidate, "slices")),
            of_base.rows,
        )
        p = spec.baseline_prefix
        status = feed.date_match_status(
            *[F.col(f"`{c}`") for c in (roles.start, roles.end, p + spec.effective, p + spec.expiry)]
        )
        price = feed.highest_unit_price(
            *[F.col(f"`{c}`") for c in (roles.price, roles.priced_unit, roles.base_unit)],
            [(F.col(f"`{unit}`"), F.col(f"`{quantity}`")) for unit, quantity in roles.units],
        )
        enriched = enriched.withColumns(
            {
                roles.date_check: status,
                roles.suggested_contract: F.lit(None).cast("string"),
                roles.highest_price: price,
            }
        )
        mapped = enriched
        for mapping, column, names in (
            (manufacturer_map, roles.manufacturer_code, roles.manufacturer_mapping),
            (vendor_map, roles.vendor_code, roles.vendor_mapping),
        ):
            # a feed row became several rows at most as often as it has candidates, so a frequent code is one of the feed
            mapped = feed.map_codes(mapped, mapping, column, *names, rows_per_slice, of_daily.hot(daily, [column], rows_per_slice))
        mapped, of_mapped = stage_summarised(mapped.withColumnRenamed(roles.candidate, p + spec.item), "mapped", outer=True)
    return feed.flag_duplicates(mapped, row_keys, rows_per_slice=rows_per_slice, rows=of_mapped.rows)


def write_integrated(
    integrated: DataFrame, folder: str, output_format: str = "parquet", prefix: str = "integrated", roles: FeedSpec = FeedSpec()
) -> str:
    """Write the integrated feed; the name carries the range of its time stamps."""
    stamps = integrated.select(roles.stamp) if roles.stamp in integrated.columns else integrated
    name = f"{prefix}_{outputs.date_range(stamps, roles.stamp, [roles.stamp_format])}"
    return outputs.write_named(integrated, folder, name, output_format)


def classify(integrated: DataFrame, spec: TableSpec = TableSpec(), legacy: bool = False) -> DataFrame:
    """Integrated rows with their bucket."""
    rules = classifying.item_rules(integrated, spec.baseline_prefix + spec.item, legacy)
    return classifying.assign_bucket(integrated, rules)


def classify_to_snapshot(integrated: DataFrame, root: str, spec: TableSpec = TableSpec(), legacy: bool = False) -> int:
    """Classify and write the rows as the newest snapshot of the classified table."""
    return snapshots.write_snapshot(classify(integrated, spec, legacy), root, note="classified")


def export(
    spark: SparkSession, classified_root: str, folder: str, roles: FeedSpec = FeedSpec(), spec: TableSpec = TableSpec()
) -> str | None:
    """Export the newest classified rows, one sub-folder per bucket. None when there are none."""
    if snapshots.latest_snapshot(spark, classified_root) is None:
        return None
    rows = snapshots.read_snapshot(spark, classified_root)
    name = outputs.export_name(rows, [roles.stamp, spec.version])
    return outputs.write_buckets(rows, folder, name)


def run_all(
    spark: SparkSession,
    drop_folder: str,
    daily_folder: str,
    root: str,
    manufacturer_map: DataFrame,
    vendor_map: DataFrame,
    permitted: DataFrame | None = None,
    spec: TableSpec = TableSpec(),
    roles: FeedSpec = FeedSpec(),
    settings: SyncSettings = SyncSettings(),
    daily_glob: str | None = None,
) -> dict:
    """sync, integrate, classify, export in order; each step reads what the one before wrote."""
    synced = sync(spark, drop_folder, f"{root}/table", f"{root}/audit", spec, settings, permitted)
    table = snapshots.read_snapshot(spark, f"{root}/table")
    daily = files.read_daily(spark, daily_folder, roles.date_columns, settings.file_format, daily_glob)
    audit_root = f"{root}/audit"

    def recorded(kind: str, work, rows):
        """Run a step and record it; a step that fails is recorded, too."""
        started, run_id = time.monotonic(), f"{kind}-{uuid.uuid4().hex[:8]}"
        record = {"run_id": run_id, "kind": kind}
        try:
            result = work()
        except Exception:
            audit_store.record_run(spark, audit_root, **record, state="failed", seconds=time.monotonic() - started)
            raise
        audit_store.record_run(spark, audit_root, **record, state="done", seconds=time.monotonic() - started, row_count=rows(result))
        return result

    def integrated_step() -> str:
        with storage.discard_staged(spark):
            integrated = integrate(daily, table, manufacturer_map, vendor_map, spec, roles)
            return write_integrated(integrated, f"{root}/integrated", roles=roles)

    count = lambda path: None if path is None else spark.read.parquet(path).count()  # noqa: E731  (from footers)
    integrated_path = recorded("integrate", integrated_step, count)
    classified_root = f"{root}/classified"
    snapshot = recorded(
        "classify",
        lambda: classify_to_snapshot(spark.read.parquet(integrated_path), classified_root, spec),
        lambda _: snapshots.state(spark, classified_root).rows,
    )
    exported = recorded("export", lambda: export(spark, classified_root, f"{root}/exports", roles, spec), lambda _: None)
    return {"sync": synced, "integrated": integrated_path, "classified": snapshot, "exported": exported}
