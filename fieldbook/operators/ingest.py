"""Strain ingest: flatten payloads, existence checks, ids, inserts, updates.

Every batch operation is set-based: one aggregation per key, one join to the
stored table, and an ``outcome`` per batch row, whatever the batch size.
Hot keys are pre-aggregated before they shuffle (``groupBy`` partial
aggregation), and joins back to the batch are left to AQE's skew-join split.

Batch order is an explicit ``seq`` column (file position, see
``sources.io.read_json_array``); it decides which duplicate wins and the
order of new ids.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.operators.ids import continue_ids
from fieldbook.schemas import AUDIT_COLUMNS
from fieldbook.session import materialize, tasks_for
from fieldbook.sources.io import fields_fit

# Outcome labels.
INSERTED = "inserted"
EXISTS = "exists"
DUPLICATE = "duplicate"
REJECTED = "rejected"
UPDATED = "updated"
GUARDED = "guarded"
UNKNOWN_ID = "unknown_id"
ERROR = "error"

# Default guard of the partial update (13 minutes, Asia/Kolkata wall clock).
DEFAULT_MIN_AGE = "13 minutes"
DEFAULT_ZONE = "Asia/Kolkata"


# ---------------------------------------------------------------- shaping
def flatten(batch: DataFrame, array_col: str = "formulation") -> DataFrame:
    """One row per element of the nested array, parent fields repeated.

    An empty or NULL array gives no row (the reference loops over it).
    """
    parents = [c for c in batch.columns if c != array_col]
    el = batch.schema[array_col].dataType.elementType
    fields = [f.name for f in el.fields]
    return batch.select(*parents, F.explode(array_col).alias("_el")).select(
        *parents, *[F.col("_el")[f].alias(f) for f in fields]
    )


def keep_known(batch: DataFrame, target_columns: list[str]) -> DataFrame:
    """Drop incoming columns the target does not have (order follows the batch)."""
    known = set(target_columns)
    return batch.select(*[c for c in batch.columns if c in known])


def stamp(df: DataFrame, run_ts, created_col: str = "created_date",
          updated_col: str = "last_updated_timestamp", keep_given: bool = False) -> DataFrame:
    """Audit stamps from one run timestamp (passed in, so reruns agree).

    ``created_date`` is the run's date, ``last_updated_timestamp`` the run's
    wall-clock time (no zone).  ``keep_given`` keeps a value the payload
    already carries.
    """
    ts = _ts_lit(run_ts)
    created = ts.cast("date")
    if keep_given and created_col in df.columns:
        created = F.coalesce(F.col(created_col).cast("date"), created)
    updated = ts
    if keep_given and updated_col in df.columns:
        updated = F.coalesce(F.col(updated_col).cast("timestamp_ntz"), ts)
    return df.withColumn(created_col, created).withColumn(updated_col, updated)


def _ts_lit(run_ts) -> Column:
    if run_ts is None:
        return now_in_zone()
    if isinstance(run_ts, Column):
        return run_ts.cast("timestamp_ntz")
    if isinstance(run_ts, (_dt.datetime, _dt.date)):
        run_ts = run_ts.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def now_in_zone(zone: str = DEFAULT_ZONE) -> Column:
    """Current wall-clock time in ``zone`` as a zone-less timestamp."""
    # session-zone wall clock (localtimestamp) converted to the target zone
    return F.convert_timezone(None, F.lit(zone), F.localtimestamp())


# ---------------------------------------------------------------- key matching
def _stored_keys(stored: DataFrame, keys: list[str], prefix: str = "_s_") -> DataFrame:
    # distinct first: duplicate stored rows are folded map-side before the shuffle
    return stored.select(*[F.col(k).alias(prefix + k) for k in keys]).dropDuplicates()


def mark_existing(batch: DataFrame, stored: DataFrame, keys: list[str], null_safe: bool = False,
                  flag: str = "_exists") -> DataFrame:
    """Batch plus a boolean ``flag``: some stored row equals it on all ``keys``.

    Plain ``=`` by default: a NULL key never matches (the reference sends it
    as text or NULL and never finds it); ``null_safe=True`` uses ``<=>``.
    """
    sk = _stored_keys(stored, keys).withColumn(flag, F.lit(True))
    conds = [
        batch[k].eqNullSafe(sk["_s_" + k]) if null_safe else batch[k] == sk["_s_" + k] for k in keys
    ]
    cond = reduce(lambda a, b: a & b, conds)
    out = batch.join(sk, cond, "left")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).drop(*["_s_" + k for k in keys])


def first_in_batch(batch: DataFrame, keys: list[str], seq: str, flag: str = "_first") -> DataFrame:
    """Batch plus ``flag``: this row is the first (lowest ``seq``) of its key group.

    NULL keys group together (tuple identity).  The per-key minimum is a
    partially aggregated ``groupBy``, so a key holding a third of the batch
    ships one row per map task; the join back is split by AQE if skewed.
    """
    firsts = batch.groupBy(*keys).agg(F.min(seq).alias("_first_seq"))
    firsts = firsts.select(*[F.col(k).alias("_f_" + k) for k in keys], "_first_seq")
    cond = reduce(lambda a, b: a & b, [batch[k].eqNullSafe(firsts["_f_" + k]) for k in keys])
    out = batch.join(firsts, cond, "inner")
    return out.withColumn(flag, F.col(seq) == F.col("_first_seq")).drop(
        "_first_seq", *["_f_" + k for k in keys])


def classify_new(batch: DataFrame, stored: DataFrame, keys: list[str], seq: str,
                 null_safe: bool = False, dedupe: bool = True, outcome: str = "outcome") -> DataFrame:
    """Each batch row labelled ``inserted`` / ``exists`` / ``duplicate``.

    Later copies of a key inside the batch are ``duplicate``; the first copy
    is ``exists`` when the stored table has the key, else ``inserted``.
    """
    def same(left: DataFrame, right: DataFrame, prefix: str, nulls: bool) -> Column:
        return reduce(lambda x, y: x & y, [
            left[k].eqNullSafe(right[prefix + k]) if nulls else left[k] == right[prefix + k] for k in keys])

    firsts = batch.groupBy(*keys).agg(F.min(seq).alias("_first_seq"))
    # stored rows meet one row per key of the batch, which AQE broadcasts when
    # it is small: then the stored table is neither shuffled nor sorted
    named = firsts.select(*[F.col(k).alias("_f_" + k) for k in keys])
    known = stored.select(*keys)
    known = known.join(named, same(known, named, "_f_", null_safe), "left_semi").select(
        *[F.col(k).alias("_s_" + k) for k in keys]).dropDuplicates().withColumn("_exists", F.lit(True))
    judged = firsts.join(known, same(firsts, known, "_s_", null_safe), "left").select(
        *[F.col(k).alias("_f_" + k) for k in keys], "_first_seq",
        F.coalesce("_exists", F.lit(False)).alias("_exists"))
    out = batch.join(judged, same(batch, judged, "_f_", True), "inner")
    later = (F.col(seq) != F.col("_first_seq")) if dedupe else F.lit(False)
    return out.withColumn(
        outcome,
        F.when(later, F.lit(DUPLICATE)).when(F.col("_exists"), F.lit(EXISTS)).otherwise(F.lit(INSERTED)),
    ).drop("_first_seq", "_exists", *["_f_" + k for k in keys])


def insert_new(batch: DataFrame, stored: DataFrame, keys: list[str], seq: str, run_ts,
               null_safe: bool = False, with_ids: bool = False, id_col: str = "id",
               id_source: DataFrame | None = None, written: bool = False):
    """Returns (rows to append, outcome per batch row).

    Rows to append are the ``inserted`` ones, stamped; with ``with_ids`` they
    get ids continuing from the max id of ``id_source`` (default: the
    stored table) in ``seq`` order.  ``written`` writes the labelled rows
    once, for callers that read both results.
    """
    labelled = classify_new(batch, stored, keys, seq, null_safe)
    if written:
        labelled = materialize(labelled, "labelled")
    new = labelled.where(F.col("outcome") == INSERTED).drop("outcome")
    if with_ids:
        new = continue_ids(new, [seq], stored if id_source is None else id_source, id_col=id_col)
    return stamp(new, run_ts), labelled


def gate_all(batch: DataFrame, stored: DataFrame, keys: list[str], batch_col: str | None = None,
             null_safe: bool = False, outcome: str = "outcome") -> DataFrame:
    """All-or-nothing (D6): if any row of a batch exists, every row of it is rejected.

    ``batch_col`` names the batch of each row (one batch when None).  The
    verdict is an aggregate, never a decision on the driver: for one batch a
    scalar subquery (no join, so the batch is not funnelled through one
    key), for several a per-batch aggregate joined back on the batch column
    (AQE broadcasts it when small and splits a skewed batch otherwise).
    """
    marked = mark_existing(batch, stored, keys, null_safe)
    if batch_col is None:
        dirty = marked.agg(F.max(F.col("_exists").cast("int")).alias("_d")).scalar()
        out = marked.withColumn("_dirty", dirty)
    else:
        verdict = marked.groupBy(batch_col).agg(F.max(F.col("_exists").cast("int")).alias("_dirty"))
        verdict = verdict.withColumnRenamed(batch_col, "_vb")
        out = marked.join(verdict, marked[batch_col].eqNullSafe(verdict["_vb"]), "inner").drop("_vb")
    return out.drop("_exists").withColumn(
        outcome, F.when(F.coalesce(F.col("_dirty"), F.lit(0)) == 1, F.lit(REJECTED)).otherwise(F.lit(INSERTED))
    ).drop("_dirty")


def insert_all_or_nothing(batch: DataFrame, stored: DataFrame, keys: list[str], seq: str, run_ts,
                          batch_col: str | None = None, id_col: str = "id", null_safe: bool = False):
    """(rows to append with ids and stamps, outcome per batch row).

    Ids continue from max(stored id) over accepted rows in (batch, seq) order.
    """
    gated = gate_all(batch, stored, keys, batch_col, null_safe)
    ok = gated.where(F.col("outcome") == INSERTED).drop("outcome")
    order = ([batch_col] if batch_col else []) + [seq]
    new = continue_ids(ok, order, stored, id_col=id_col)
    return stamp(new, run_ts), gated


# ---------------------------------------------------------------- updates
def _fields_ok(fields: Column, schema: T.StructType, settable: list[str]) -> Column:
    """True when every present field is a known column with a non-NULL, castable value."""
    known = F.array(*[F.lit(c) for c in settable])
    keys_ok = F.forall(F.map_keys(fields), lambda k: F.array_contains(known, k))
    casts = []
    for f in schema.fields:
        if f.name not in settable:
            continue
        v = fields[f.name]
        casts.append(F.when(F.map_contains_key(fields, F.lit(f.name)),
                            v.isNotNull() & _try_cast(v, f.dataType).isNotNull()).otherwise(F.lit(True)))
    values_ok = reduce(lambda a, b: a & b, casts) if casts else F.lit(True)
    return keys_ok & values_ok


def _try_cast(v: Column, dt: T.DataType) -> Column:
    return v.try_cast(dt)


def apply_updates(stored: DataFrame, updates: DataFrame, now, id_col: str = "id", seq: str = "seq",
                  fields_col: str = "fields", min_age: str | None = DEFAULT_MIN_AGE,
                  updated_col: str = "last_updated_timestamp", duplicate: str = "first"):
    """Guarded partial updates by id.  Returns (new table, outcome per update).

    ``now`` is the run's wall-clock time (text, datetime or Column); None
    means the current time in Asia/Kolkata, as the reference stamps it.

    ``updates`` has (``seq``, ``id_col``, ``fields_col`` map<string,string>):
    only the fields present are set, cast to the column type, and
    ``updated_col`` becomes ``now``, whatever stamp the payload gives.  A row is changed only if its
    ``updated_col`` is older than ``now - min_age``.  Of several updates of
    one id the first (or last) by ``seq`` is applied, the others are
    ``duplicate``.  Unknown id -> ``unknown_id``; an unknown field, an
    explicit NULL or a value that does not cast -> ``error`` (row unchanged).
    """
    now_c = _ts_lit(now)
    settable = [c for c in stored.columns if c not in (id_col, updated_col)]
    given = F.map_filter(fields_col, lambda k, v: k != F.lit(updated_col))
    pick = F.min_by if duplicate == "first" else F.max_by
    winners = updates.groupBy(id_col).agg(
        pick(F.struct(F.col(seq).alias("s"), given.alias("f")), F.col(seq)).alias("_w")
    ).select(F.col(id_col).alias("_wid"), F.col("_w.s").alias("_wseq"), F.col("_w.f").alias("_wf"))

    cur = stored.select(F.col(id_col).alias("_sid"), F.col(updated_col).alias("_sts"))
    guard = F.col("_sts") < (now_c - F.expr(f"INTERVAL {min_age}")) if min_age else F.lit(True)
    judged = winners.join(cur, winners["_wid"] == cur["_sid"], "left").select(
        "_wid", "_wseq", "_wf",
        F.when(F.col("_sid").isNull(), F.lit(UNKNOWN_ID))
        .when(~_fields_ok(F.col("_wf"), stored.schema, settable), F.lit(ERROR))
        .when(~F.coalesce(guard, F.lit(False)), F.lit(GUARDED))
        .otherwise(F.lit(UPDATED)).alias("_verdict"),
    )

    outcomes = updates.join(judged.select("_wid", "_wseq", "_verdict"),
                            updates[id_col].eqNullSafe(F.col("_wid")), "left")
    outcomes = outcomes.withColumn(
        "outcome",
        F.when(F.col(id_col).isNull(), F.lit(UNKNOWN_ID))
        .when(F.col(seq) != F.col("_wseq"), F.lit(DUPLICATE))
        .otherwise(F.col("_verdict")),
    ).drop("_wid", "_wseq", "_verdict")

    applied = judged.where(F.col("_verdict") == UPDATED).select("_wid", "_wf")
    joined = stored.join(applied, stored[id_col] == applied["_wid"], "left")
    hit = F.col("_wid").isNotNull()
    cols = []
    for f in stored.schema.fields:
        c = f.name
        if c in settable:
            cols.append(
                F.when(hit & F.map_contains_key(F.col("_wf"), F.lit(c)), _try_cast(F.col("_wf")[c], f.dataType))
                .otherwise(F.col(c)).alias(c)
            )
        elif c == updated_col:
            cols.append(F.when(hit, now_c).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return joined.select(*cols), outcomes


def upsert(stored: DataFrame, batch: DataFrame, keys: list[str], now, id_col: str = "id", seq: str = "seq",
           fields_col: str = "fields", min_age: str | None = DEFAULT_MIN_AGE,
           null_safe: bool = False, duplicate: str = "first"):
    """Three-way batch of field maps.  Returns (new table, outcome per batch row).

    A row whose map has ``id_col`` is a partial update (``apply_updates``);
    otherwise it is an insert: ``exists`` when the stored table has its
    ``keys``, else ``inserted`` with an id continuing from max(id) in ``seq``
    order and stamped with ``now``.  An insert carries every stored column
    its map names (cast to the column type; unknown fields are dropped); one
    with a value that does not cast is an ``error`` and inserts nothing.
    No in-batch dedupe of inserts, as in the reference; the new table is
    stored rows (updated) plus inserted ones.
    """
    has_id = F.map_contains_key(F.col(fields_col), F.lit(id_col))
    upd = batch.where(has_id).select(
        seq, F.col(fields_col)[id_col].try_cast("long").alias(id_col),
        F.map_filter(fields_col, lambda k, v: k != F.lit(id_col)).alias(fields_col),
    )
    ins_maps = batch.where(~has_id)
    types = {f.name: f.dataType for f in stored.schema.fields}
    payload = [c for c in stored.columns if c != id_col and c not in AUDIT_COLUMNS]
    fits = fields_fit(F.col(fields_col), T.StructType([f for f in stored.schema.fields if f.name in payload]))
    ins = ins_maps.select(seq, fits.alias("_fits"),
                          *[F.col(fields_col)[c].try_cast(types[c]).alias(c) for c in payload])

    updated_tbl, upd_out = apply_updates(stored, upd, now, id_col, seq, fields_col, min_age,
                                         duplicate=duplicate)
    labelled = mark_existing(ins, stored, keys, null_safe)
    labelled = labelled.withColumn("outcome", F.when(~F.col("_fits"), F.lit(ERROR))
                                   .when(F.col("_exists"), F.lit(EXISTS)).otherwise(F.lit(INSERTED)))
    new = continue_ids(labelled.where(F.col("outcome") == INSERTED).drop("outcome", "_exists", "_fits"), [seq], stored,
                       id_col=id_col)
    new = stamp(new, now)
    new_rows = new.select(*[
        F.col(c) if c in new.columns else F.lit(None).cast(types[c]).alias(c) for c in stored.columns
    ])
    ins_out = labelled.join(new.select(seq, F.col(id_col).alias("_nid")), seq, "left").select(
        seq, F.coalesce("_nid", F.lit(None).cast("long")).alias(id_col), "outcome")
    outcomes = upd_out.select(seq, id_col, "outcome").unionByName(ins_out)
    return updated_tbl.unionByName(new_rows), outcomes


# ---------------------------------------------------------------- loose checks
FEW_CANDIDATES = 16


def _value_sets(df: DataFrame, columns: list[str]) -> Column:
    """The distinct values of a row as texts, NULL a value of its own."""
    return F.sort_array(F.array_distinct(F.array(*[
        F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in columns])))


_TASK_SETS = 500_000  # value sets, or probes, dealt to one task
_BUCKETS = 1 << 16
_SENT_KEYS = 100_000  # keys of frequent values only are broadcast up to so many


def _deal(df: DataFrame, key: str, size: int) -> DataFrame:
    """``df`` dealt by ``key`` into more tasks than the session's number, where ``size`` rows need them."""
    n = tasks_for(df.sparkSession, size, _TASK_SETS)
    return df.repartition(n, key) if n > tasks_for(df.sparkSession, 0, _TASK_SETS) else df


def _distinct_sets(sets: DataFrame) -> DataFrame:
    """The distinct rows of ``sets(_s)``, dealt by ``_s`` as their number demands."""
    kinds = sets.agg(F.approx_count_distinct(F.xxhash64("_s"))).first()[0]
    return _deal(sets, "_s", kinds).distinct()


def _bucket(value: str) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(_BUCKETS)).cast("int").alias("_b")


def _frequencies(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How often values stand in ``stored(_s)``: (_b, _m) per bucket of values, and (_v, _n) of frequent values.

    Frequent values, over 1 in 1024 of all and so at most as many, are
    counted by themselves and left out of their bucket.  Both are small
    however many values there are.
    """
    each = stored.select(F.explode("_s").alias("_v"))
    buckets = materialize(each.groupBy(_bucket("_v")).agg(F.count(F.lit(1)).alias("_m")), "contained-buckets")
    least = (buckets.agg(F.sum("_m")).first()[0] or 0) // 1024 + 1
    heavy = buckets.where(F.col("_m") > least).select("_b")
    often = materialize(each.select("_v", _bucket("_v")).join(F.broadcast(heavy), "_b", "left_semi").groupBy("_b", "_v").agg(
        F.count(F.lit(1)).alias("_n")).where(F.col("_n") > least), "contained-often")
    taken = often.groupBy("_b").agg(F.sum("_n").alias("_t"))
    rest = buckets.join(F.broadcast(taken), "_b", "left").select("_b", (F.col("_m") - F.coalesce("_t", F.lit(0))).alias("_m"))
    return rest, often.select("_v", "_n")


def _ranked(sets: DataFrame, buckets: DataFrame, often: DataFrame) -> DataFrame:
    """(_r, _rare): the values of ``sets(_s)``, rarest first, frequent ones last, and how many are not frequent.

    Sets that are dealt by ``_s`` stay in their tasks.
    """
    each = sets.select("_s", F.explode("_s").alias("_v")).select("_s", "_v", _bucket("_v"))
    each = each.join(F.broadcast(often), "_v", "left").join(F.broadcast(buckets), "_b", "left")
    place = F.struct(F.col("_n").isNotNull().alias("often"), F.coalesce("_n", "_m", F.lit(0)).alias("n"), F.col("_v").alias("v"))
    return each.groupBy("_s").agg(F.sort_array(F.collect_list(place)).alias("_o")).select(
        F.transform("_o", lambda e: e["v"]).alias("_r"), F.size(F.filter("_o", lambda e: ~e["often"])).alias("_rare"))


def contained_sets(batch: DataFrame, stored: DataFrame, few: int = FEW_CANDIDATES) -> DataFrame:
    """(_s): the sets of ``batch(_s)`` that contain some set of ``stored(_s)``.

    A containment join.  Values have one order, about rarest first by the
    stored sets (``_frequencies``).  A stored set is keyed by its first
    value; where more than ``few`` sets share a key, those grow it by their
    next value, and so on, so keys end up as long as their counts demand.  A
    batch set probes with the values it holds, and grows only probes that
    met a key that grew.  A key that is a whole set decides by itself, one of
    a single set by the set it brings along; the others give at most ``few``
    candidates a probe, whose remaining values are then looked up.

    Sets and probes are dealt by their number, so that no task gets more as
    tables grow.  Probes of frequent values alone, which would all go to a few
    tasks, meet their keys by broadcast: those are keys of stored sets that
    have no other values.

    Rounds: one per key length, at most the number of columns.  Each writes
    its surviving probes; only numbers of rows reach the driver.
    """
    ranks = _frequencies(stored)
    left = materialize(_ranked(_distinct_sets(stored.select("_s")), *ranks), "contained-ranked")
    probes = materialize(_ranked(_distinct_sets(batch.select("_s")), *ranks).select(
        "_r", "_rare", F.array().cast("array<string>").alias("_k"), F.lit(0).alias("_at"), F.lit(False).alias("_often")),
        "contained-probes")
    hits = []
    for length in range(1, 1 << 10):
        size = max(probes.count(), left.count())
        cut = left.select(F.slice("_r", 1, length).alias("_k"), "_r", "_rare")

        def keys(sets: DataFrame) -> DataFrame:
            return sets.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.max(F.size("_r") == length).alias("_whole"),
                                          F.first("_r").alias("_one"))

        grown = probes.where(F.col("_at") < F.size("_r")).select("_r", "_rare", "_often", F.explode(F.transform(
            F.sequence(F.col("_at") + 1, F.size("_r")), lambda i: F.struct(
                F.concat("_k", F.array(F.get("_r", i - 1))).alias("k"), i.alias("at")))).alias("_e"))
        grown = grown.select("_r", "_rare", F.col("_e.k").alias("_k"), F.col("_e.at").alias("_at"), (
            F.col("_e.at") > F.col("_rare") if length == 1 else F.col("_often")).alias("_often"))
        met = _deal(grown.where(~F.col("_often")), "_k", size).join(keys(_deal(cut.where("_rare > 0"), "_k", size)), "_k")
        often = materialize(keys(cut.where("_rare = 0")), "contained-keys")
        n_often = often.count()
        if n_often:
            met = met.unionByName(grown.where("_often").join(F.broadcast(often) if n_often <= _SENT_KEYS else often, "_k"))
        inside = F.size(F.array_except("_one", "_r")) == 0
        met = met.withColumn("_kind", F.when(F.col("_whole"), 0).when(F.col("_n") == 1, F.when(inside, 0)).when(
            F.col("_n") <= few, 1).otherwise(2)).where(F.col("_kind").isNotNull())
        met = materialize(met.drop("_n", "_whole", "_one"), "contained-met")
        near = met.where("_kind = 1").select("_r", "_k").join(cut.select("_k", F.col("_r").alias("_t")), "_k")
        hits.append(materialize(met.where("_kind = 0").select("_r").unionByName(
            near.where(F.size(F.array_except("_t", "_r")) == 0).select("_r")).distinct(), "contained-hits"))
        done = reduce(DataFrame.unionByName, hits).distinct()
        probes = met.where("_kind = 2").drop("_kind").join(done, "_r", "left_anti")
        probes = materialize(probes, "contained-probes")
        if probes.limit(1).count() == 0:
            return done.select(F.sort_array("_r").alias("_s"))
        open_keys = keys(cut).where((F.col("_n") > few) & ~F.col("_whole")).select("_k")
        left = materialize(left.join(open_keys, F.slice("_r", 1, length) == F.col("_k"), "left_semi"), "contained-ranked")
    raise ValueError("too many columns")


def loose_exists(batch: DataFrame, stored: DataFrame, row_id: str, columns: list[str] | None = None,
                 flag: str = "present", few: int = FEW_CANDIDATES) -> DataFrame:
    """A batch row is present when some stored row has *every* common
    column's value somewhere among the batch row's values (any column).

    Values compare as text; NULL matches NULL.  That is containment of the
    stored row's set of values in the batch row's, found by
    ``contained_sets`` without a nested loop, also where all columns have few
    values.  Output: batch + flag.
    """
    common = [c for c in (columns or batch.columns) if c in stored.columns and c != row_id]
    if not common:
        return batch.withColumn(flag, F.lit(False))
    mine, theirs = _value_sets(batch, common), _value_sets(stored, common)
    hits = contained_sets(batch.select(mine.alias("_s")), stored.select(theirs.alias("_s")), few)
    rows = batch.withColumn("_fb_set", mine)
    size = hits.count()
    hits = _deal(hits.select(F.col("_s").alias("_fb_hit"), F.lit(True).alias("_fb_flag")), "_fb_hit", size)
    return _deal(rows, "_fb_set", size).join(hits, F.col("_fb_set") == F.col("_fb_hit"), "left").select(
        *[rows[f"`{c}`"] for c in batch.columns if c != flag], F.coalesce("_fb_flag", F.lit(False)).alias(flag))


def row_difference(batch: DataFrame, table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Batch rows with no equal row in ``table`` (all shared columns, by name, NULL = NULL).

    Duplicates of the batch are kept (unlike ``exceptAll``).
    """
    cols = [c for c in (columns or batch.columns) if c in table.columns]
    t = table.select(*[F.col(c).alias("_t_" + c) for c in cols]).dropDuplicates()
    cond = reduce(lambda a, b: a & b, [batch[c].eqNullSafe(t["_t_" + c]) for c in cols])
    return batch.join(t, cond, "left_anti")


def row_difference_wide(batch: DataFrame, table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """D8 for wide rows and a large table: the rows of ``row_difference``, with the table's rows left where they are.

    128-bit fingerprints are exchanged instead of rows.  Only rows of the
    table whose fingerprint some batch row has move, once each, and equality
    is decided on the rows themselves, so a collision costs time and never a
    row.  Columns whose types differ between the two are compared, but are no
    part of the fingerprint.  Maps are refused, as Spark cannot compare them.
    """
    cols = [c for c in (columns or batch.columns) if c in table.columns]
    alike = [c for c in cols if batch.schema[c].dataType == table.schema[c].dataType]
    if not alike:
        raise ValueError("no shared column of one type: cast the batch first")

    def marks(df: DataFrame) -> list[Column]:
        # NULLs do not change these hashes, so what is NULL goes in as well
        held = [F.col(f"`{c}`") for c in alike] + [F.col(f"`{c}`").isNull() for c in alike]
        return [F.xxhash64(F.lit(i), *held).alias(f"_fp{i}") for i in (1, 2)]

    prints = ["_fp1", "_fp2"]
    asked = batch.select(*marks(batch)).distinct()
    hits = materialize(table.select(*marks(table)).join(asked, prints, "left_semi").distinct(), "row-prints")
    suspects = (table.select(*marks(table), *[F.col(f"`{c}`").alias("_t_" + c) for c in cols])
                .join(hits, prints, "left_semi").dropDuplicates())
    mine = batch.select("*", *marks(batch))
    # a number, so that the values are no join keys: rows stay where their fingerprints have brought them
    equal = F.least(F.lit(1), *[mine[f"`{c}`"].eqNullSafe(suspects[f"`_t_{c}`"]).cast("int") for c in cols]) == 1
    return mine.join(suspects, reduce(lambda a, b: a & b, [mine[p] == suspects[p] for p in prints], equal),
                     "left_anti").drop(*prints)


def add_rows_replace(table: DataFrame, batch: DataFrame, row_id: str, run_ts) -> DataFrame:
    """Add batch rows not loosely present (D7), then restamp every row.

    The whole result is the table's next snapshot (write with
    ``sources.io.write_snapshot``), computed once per batch.
    """
    known = keep_known(batch, table.columns + [row_id])
    flagged = loose_exists(known, table, row_id)
    new = flagged.where(~F.col("present")).drop("present", row_id)
    out = table.unionByName(new, allowMissingColumns=True)
    return stamp(out, run_ts)
