"""Stage boundaries: where a plan is read by several branches, materialise it once.

``checkpoint`` writes the rows to the shared folder the session names in
``spark.checkpoint.dir`` (never a machine-local folder) and cuts the lineage, so a lost
executor costs a re-read rather than a recompute and the downstream plans stay small;
``persist`` keeps them in executor memory/disk (recomputed from lineage when lost).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from geoprep.session import ensure_checkpoint_dir, scratch_dir


def is_staged(df: DataFrame) -> bool:
    """True when the frame is already a scan of checkpointed rows (no lineage to cut)."""
    try:
        plan = df._jdf.queryExecution().analyzed()
        while plan.getClass().getSimpleName() in ("Project", "SubqueryAlias") and plan.children().size() == 1:
            plan = plan.children().apply(0)
        return plan.getClass().getSimpleName() in ("LogicalRDD", "InMemoryRelation")
    except Exception:  # noqa: BLE001 - e.g. a Connect session: just stage
        return False


def is_plain_scan(df: DataFrame) -> bool:
    """True when the frame only reads a table: filters and column selections/renames over
    a file scan.  Re-reading it costs what reading a staged copy would, and its plan is
    small, so staging it would only copy the input."""
    try:
        plan = df._jdf.queryExecution().analyzed()
        while True:
            name = plan.getClass().getSimpleName()
            if name == "Project":
                exprs = plan.projectList()
                for i in range(exprs.size()):
                    e = exprs.apply(i)
                    kind = e.getClass().getSimpleName()
                    if kind == "Alias":
                        kind = e.child().getClass().getSimpleName()
                    if kind != "AttributeReference":
                        return False
            elif name not in ("Filter", "SubqueryAlias"):
                return name in ("LogicalRelation", "LogicalRDD", "InMemoryRelation")
            if plan.children().size() != 1:
                return False
            plan = plan.children().apply(0)
    except Exception:  # noqa: BLE001
        return False


def stage(df: DataFrame, mode: str | None = "checkpoint") -> DataFrame:
    """Materialise ``df`` once (see module doc); a frame that is already staged or only
    reads a table is returned as it is."""
    if mode in ("checkpoint", "persist") and (is_staged(df) or is_plain_scan(df)):
        return df
    if mode == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode in (None, "none"):
        return df
    raise ValueError(f"unknown stage mode {mode!r}")


def stage_with_metrics(df: DataFrame, mode: str | None, metrics: dict):
    """Stage ``df`` and compute aggregate ``metrics`` (name -> Column) in the same pass,
    through an observation on the staging job.  When nothing is staged (already staged,
    or no staging), the metrics come from one aggregate over the frame.  Returns
    (frame, {name: value})."""
    from pyspark.sql import Observation

    if mode == "checkpoint" and not is_staged(df) and not is_plain_scan(df):
        import uuid

        obs = Observation(f"stage_metrics_{uuid.uuid4().hex[:12]}")   # unique: jobs may run concurrently
        staged = stage(df.observe(obs, *[c.alias(n) for n, c in metrics.items()]), mode)
        return staged, dict(obs.get)
    staged = stage(df, mode)
    row = staged.agg(*[c.alias(n) for n, c in metrics.items()]).collect()[0]
    return staged, row.asDict()


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back: later
    branches prune its columns and know its size, and what a row's partition or place was
    when written stays so."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
