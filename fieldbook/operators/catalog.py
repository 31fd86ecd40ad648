"""Catalogue normaliser and catalogue queries.

Raw documents carry comma lists (products, crops, diseases, pests).  The
normaliser turns them into four dimensions, three bridges and a document
table whose list columns become id lists; the queries join them back and
gather names into arrays.

All steps are joins, aggregations and generators; the only ordering work is
``ids.dense_ids`` (range-parallel numbering).  First-seen order is defined by
an explicit row key of the raw table plus the item position in the list.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.functions.columns import list_items
from fieldbook.operators.ids import dense_ids, max_id
from fieldbook.schemas import BRIDGES, DOCUMENT_LISTS
from fieldbook.session import materialize, tasks_for

_TASK_DOCUMENTS = 100_000  # documents dealt to one task
_RANGE_DOCUMENTS = 400_000  # documents numbered in one
_WHOLE = ("byte", "short", "integer", "long")


def explode_list(raw: DataFrame, list_col: str, row_key: str, name_col: str = "name",
                 pos_col: str = "pos") -> DataFrame:
    """One row per list item: (row_key, pos, name), names stripped.

    A NULL list gives one row with NULL pos and name; '' gives one '' item.
    """
    return raw.select(
        F.col(row_key),
        F.posexplode_outer(list_items(list_col)).alias(pos_col, name_col),
    )


def explode_lists(raw: DataFrame, row_key: str, list_cols: list[str]) -> DataFrame:
    """All list columns exploded into one long table (list, row_key, pos, name).

    One scan of ``raw``, written once to the checkpoint folder: dimensions
    and id lists of every list column read it instead of re-reading raw.
    """
    return materialize(_items(raw, row_key, list_cols), "items")


def _items(raw: DataFrame, row_key: str, list_cols: list[str]) -> DataFrame:
    """``explode_lists``, not written."""
    texts = F.array(*[F.struct(F.lit(c).alias("list"), F.col(c).alias("text")) for c in list_cols])
    return raw.select(row_key, F.explode(texts).alias("_l")).select(
        F.col("_l.list").alias("list"), row_key,
        F.posexplode_outer(list_items(F.col("_l.text"))).alias("pos", "name"))


def _dealt(documents: DataFrame, key: str) -> DataFrame:
    """Documents dealt by their key, about ``_TASK_DOCUMENTS`` to a task; what is exploded from them stays there."""
    return documents.repartition(tasks_for(documents.sparkSession, documents.count(), _TASK_DOCUMENTS), key)


def _ranges(documents: DataFrame, buckets: int | None = None) -> int | None:
    """Ranges to number written documents in: ``buckets``, or None while the session's number keeps them
    within ``_RANGE_DOCUMENTS`` each, or as many as do."""
    if buckets is not None:
        return buckets
    spark = documents.sparkSession
    tasks = tasks_for(spark, documents.count(), _RANGE_DOCUMENTS)
    return tasks if tasks > tasks_for(spark, 0, _RANGE_DOCUMENTS) else None


def _span(raw: DataFrame, row_key: str, list_cols: list[str]):
    """(least row key, greatest, longest list text) of the rows, or None where the key is no whole number."""
    if raw.schema[row_key].dataType.typeName() not in _WHOLE:
        return None
    low, high, longest = raw.agg(F.min(row_key), F.max(row_key), F.max(F.greatest(
        F.lit(0), *[F.length(c) for c in list_cols]))).first()
    return low or 0, high or 0, longest or 0


def _first_place(df: DataFrame, keys: list[str], row_key: str, *pos: str, span=None) -> DataFrame:
    """(keys, _k, and a ``_`` column per position): the least (row key, one or two positions) of every key, NULLs first.

    With a whole-number row key the place is one number, whose minimum a
    hash aggregation holds in place.  The minimum of a struct would make
    every task sort all its rows before it merges any.  The number is a long
    where the ``_span`` of the rows (a list has fewer items than characters,
    plus one) leaves room for it, else a decimal.
    """
    names = ["_k"] + [f"_p{i}" for i in range(len(pos))]
    kind = df.schema[row_key].dataType
    if kind.typeName() not in _WHOLE:
        least = df.groupBy(*keys).agg(F.min(F.struct(F.col(row_key).alias("_k"), *[
            F.col(p).alias(n) for p, n in zip(pos, names[1:])])).alias("_f"))
        return least.select(*keys, "_f.*")
    if span is not None:
        low, high, longest = span
        bits = (longest + 2).bit_length()  # positions up to ``longest``, one more each, and 0 for NULL
        if (high - low + 1).bit_length() + bits * len(pos) <= 62:
            return _least_long(df, keys, row_key, pos, names, low, bits)
    # NULL comes first: a key of -2^63 - 1, a position of 0
    key = f"coalesce(cast(`{row_key}` as decimal(20,0)), -9223372036854775809BD)"
    place = " + ".join([f"coalesce(`{p}` + 1L, 0L) * {1 << 31 * i}L" for i, p in enumerate(reversed(pos))])
    size = 1 << 31 * len(pos)
    code = f"cast({key} * {size}BD + cast({place} as decimal(19,0)) as decimal(38,0))"
    out = df.groupBy(*keys).agg(F.min(F.expr(code)).alias("_c")).withColumn("_r", F.expr(f"pmod(_c, {size}BD)"))
    out = out.select(*keys, F.expr(f"try_cast((_c - _r) / {size}BD as decimal(20,0))").alias("_d"),
                     F.col("_r").cast("long").alias("_r"))
    return out.select(
        *keys, F.expr(f"case when _d >= -9223372036854775808BD then cast(_d as {kind.simpleString()}) end").alias("_k"),
        *[F.expr(f"cast(nullif(_r div {1 << 31 * (len(pos) - 1 - i)}L % {1 << 31}L, 0L) - 1L as int)").alias(n)
          for i, n in enumerate(names[1:])])


def _least_long(df: DataFrame, keys: list[str], row_key: str, pos, names: list[str], low: int, bits: int) -> DataFrame:
    """``_first_place`` where key and positions fit one long: the key's distance from ``low``, then ``bits`` a position."""
    wide = bits * len(pos)
    code = F.shiftleft(F.coalesce(F.col(row_key).cast("long") - F.lit(low).cast("long") + 1, F.lit(0).cast("long")), wide)
    shifts = [bits * i for i in reversed(range(len(pos)))]
    for p, shift in zip(pos, shifts):
        code = code + F.shiftleft(F.coalesce(F.col(p).cast("long") + 1, F.lit(0).cast("long")), shift)
    least = df.groupBy(*keys).agg(F.min(code).alias("_c"))

    def back(c: Column, start: int) -> Column:
        return F.when(c > 0, c - 1 + F.lit(start).cast("long"))

    mask = F.lit((1 << bits) - 1).cast("long")
    return least.select(
        *keys, back(F.shiftright("_c", wide), low).cast(df.schema[row_key].dataType).alias("_k"),
        *[back(F.shiftright("_c", shift).bitwiseAND(mask), 0).cast("int").alias(n) for n, shift in zip(names[1:], shifts)])


def dimension_from_items(items: DataFrame, row_key: str, name_col: str, id_col: str,
                         keep_null: bool = True, drop_empty: bool = False,
                         buckets: int | None = None, existing: DataFrame | None = None) -> DataFrame:
    """Distinct names of exploded items (row_key, pos, name), ids in first-seen order.

    With ``existing`` (a dimension written earlier) known names keep their
    ids and new names continue from its max id, so ids stay stable across
    runs; the result is the existing rows plus the new ones.
    """
    if not keep_null:
        items = items.where(F.col("name").isNotNull())
    if drop_empty:
        items = items.where((F.col("name") != "") | F.col("name").isNull())
    # partial (map-side) aggregation per name before the shuffle: a hot name
    # costs one row per map task, not one per occurrence
    first = _first_place(items, ["name"], row_key, "pos").select(
        F.col("name").alias(name_col), "_k", F.col("_p0").alias("_p"))
    if existing is None:
        return dense_ids(first, ["_k", "_p"], id_col=id_col, buckets=buckets).select(name_col, id_col)
    known = existing.select(F.col(name_col).alias("_known"))
    new = first.join(known, first[name_col].eqNullSafe(known["_known"]), "left_anti")
    start = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar() + F.lit(1)
    numbered = dense_ids(new, ["_k", "_p"], id_col=id_col, start=start, buckets=buckets).select(name_col, id_col)
    return existing.select(name_col, id_col).unionByName(numbered)


def dimension(raw: DataFrame, list_col: str, row_key: str, name_col: str, id_col: str,
              keep_null: bool = True, drop_empty: bool = False,
              buckets: int | None = None, existing: DataFrame | None = None) -> DataFrame:
    """Distinct stripped names of a list column, ids 1..n in first-seen order.

    NULL lists give a NULL member and '' a '' member (``keep_null`` /
    ``drop_empty`` remove them).
    """
    items = explode_list(raw, list_col, row_key, "name")
    return dimension_from_items(items, row_key, name_col, id_col, keep_null, drop_empty, buckets, existing)


def _name_join(left: DataFrame, dim: DataFrame, left_name: str, dim_name: str, how: str = "inner"):
    """Join on names with NULL = NULL (a NULL item links to the NULL member)."""
    return left.join(dim, left[left_name].eqNullSafe(dim[dim_name]), how)


def _first_links(raw: DataFrame, row_key: str, list_a: str, list_b: str,
                 dim_a: DataFrame, dim_b: DataFrame) -> DataFrame:
    """Distinct (a id, b id) pairs stated by the rows, with their first-seen key.

    Every row states each pair of its two lists (the bridge's own content);
    the pairs are de-duplicated by name with partial aggregation before the
    two dimension joins.  ``dim_a`` / ``dim_b`` are (name, id) frames.
    Returns (_a, _b, _k, _pa, _pb).
    """
    pairs = raw.select(
        F.col(row_key),
        F.posexplode_outer(list_items(list_a)).alias("_pa", "_na"),
        F.col(list_b),
    ).select(row_key, "_pa", "_na", F.posexplode_outer(list_items(list_b)).alias("_pb", "_nb"))
    first = _first_place(pairs, ["_na", "_nb"], row_key, "_pa", "_pb")
    da = dim_a.toDF("_da_name", "_a")
    db = dim_b.toDF("_db_name", "_b")
    linked = _name_join(_name_join(first, da, "_na", "_da_name"), db, "_nb", "_db_name")
    return linked.select("_a", "_b", "_k", F.col("_p0").alias("_pa"), F.col("_p1").alias("_pb"))


def bridge(raw: DataFrame, list_a: str, list_b: str, dim_a: DataFrame, dim_b: DataFrame,
           row_key: str, a_name: str, a_id: str, b_name: str, b_id: str, bridge_id: str,
           buckets: int | None = None) -> DataFrame:
    """Distinct (a_id, b_id) pairs of the two lists of each row, ids in first-seen order."""
    links = _first_links(raw, row_key, list_a, list_b, dim_a.select(a_name, a_id), dim_b.select(b_name, b_id))
    return dense_ids(links, ["_k", "_pa", "_pb"], id_col=bridge_id, buckets=buckets).select(
        F.col("_a").alias(a_id), F.col("_b").alias(b_id), bridge_id)


def id_list_from_items(items: DataFrame, dim: DataFrame, row_key: str, name_col: str, id_col: str,
                        out_col: str | None = None, skip_empty: bool = True) -> DataFrame:
    """Per row: the ids of its list items in list order, comma joined (D4 + E8).

    ``items`` = (row_key, pos, name) with one NULL-pos row for a NULL list.
    NULL list -> NULL; items empty after stripping are skipped, so a list of
    only empties gives ''.  The dimension join is left to AQE (broadcast when
    the dimension is small at run time, shuffle join otherwise).
    """
    out_col = out_col or id_col
    d = dim.select(F.col(name_col).alias("_dn"), F.col(id_col).alias("_id"))
    looked = items.join(d, items["name"] == d["_dn"], "left")
    keep = F.col("_id").isNotNull()
    if skip_empty:
        keep = keep & (F.col("name") != "")
    agg = looked.groupBy(row_key).agg(
        F.sort_array(F.collect_list(F.when(keep, F.struct(F.col("pos").alias("p"), F.col("_id").alias("i")))))
        .alias("_l"),
        F.max(F.col("pos").isNull()).alias("_null"),
    )
    return agg.select(
        row_key,
        F.when(F.col("_null"), F.lit(None).cast("string"))
        .otherwise(F.array_join(F.transform("_l", lambda e: e["i"].cast("string")), ",")).alias(out_col),
    )


def id_list(raw: DataFrame, list_col: str, dim: DataFrame, row_key: str, name_col: str,
            id_col: str, out_col: str | None = None, skip_empty: bool = True) -> DataFrame:
    """Per raw row: ids of the list's names in list order, comma joined; (row_key, out_col)."""
    items = explode_list(raw, list_col, row_key, "name")
    return id_list_from_items(items, dim, row_key, name_col, id_col, out_col, skip_empty)


def all_id_lists(items: DataFrame, dims: DataFrame, row_key: str, out_cols: dict[str, str]) -> DataFrame:
    """``id_list_from_items`` for every list at once: one lookup join, one ``groupBy`` of the row key.

    ``items`` = (list, row_key, pos, name), ``dims`` = (list, name, _id),
    ``out_cols`` maps a list to its output column.
    """
    d = dims.select(F.col("list").alias("_dl"), F.col("name").alias("_dn"), "_id")
    looked = items.join(d, (items["list"] == d["_dl"]) & (items["name"] == d["_dn"]), "left")
    # what shows: an id, or that the list is NULL (its position is); one array for all lists
    shown = (F.col("_id").isNotNull() & (F.col("name") != "")) | F.col("pos").isNull()
    entry = F.struct(F.array_position(F.array(*[F.lit(c) for c in out_cols]), F.col("list")).alias("l"),
                     F.col("pos").alias("p"), F.col("_id").alias("i"))
    agg = looked.groupBy(row_key).agg(F.collect_list(F.when(shown, entry)).alias("_all")).select(
        row_key, F.sort_array("_all").alias("_all"))

    def text(number: int) -> Column:
        mine = F.filter("_all", lambda e: e["l"] == number)
        return F.when(~F.exists(mine, lambda e: e["p"].isNull()),
                      F.array_join(F.transform(mine, lambda e: e["i"].cast("string")), ","))

    return agg.select(row_key, *[text(n).alias(out) for n, out in enumerate(out_cols.values(), 1)])


class NormalisedTables(Mapping):
    """The 8 normalised tables, each built on first access.

    Shared parts (the exploded lists, the numbered dimensions, the numbered
    bridges) are computed once and reused by every table that needs them;
    a caller reading only the dimensions never pays for bridges or the
    document table.
    """

    def __init__(self, build: dict, names: list[str], document_lists=None):
        self._build = build
        self._names = names
        self._done: dict[str, DataFrame] = {}
        self._document_lists = document_lists

    def document_lists(self) -> DataFrame:
        """The document table before ``document_ID`` is drawn (raw columns + id
        lists), for readers that do not need the document number."""
        return self._document_lists()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._done:
            self._done[name] = self._build[name]()
        return self._done[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def _first_names(items: DataFrame, row_key: str, keep_null: bool, drop_empty: bool, span=None) -> DataFrame:
    """(list, name, _k, _p): every name of every list with its first-seen place."""
    if not keep_null:
        items = items.where(F.col("name").isNotNull())
    if drop_empty:
        items = items.where((F.col("name") != "") | F.col("name").isNull())
    return _first_place(items, ["list", "name"], row_key, "pos", span=span).withColumnRenamed("_p0", "_p")


def _bridge_links(raw: DataFrame, dims: DataFrame, row_key: str, bridges: list, span=None) -> DataFrame:
    """(bridge, _a, _b, _k, _pa, _pb): the distinct id pairs of all bridges with their first-seen place.

    Each list is cut once a row, and pairs are told apart by their names and the bridge's number.
    """
    used = sorted({c for _b, la, lb, _i in bridges for c in (la, lb)})
    cut = raw.select(F.col(row_key).alias("_k"), *[list_items(c).alias(c) for c in used])
    both = F.array(*[F.struct(F.lit(n).alias("_n"), F.col(la).alias("ta"), F.col(lb).alias("tb"))
                     for n, (_b, la, lb, _i) in enumerate(bridges, 1)])
    pairs = cut.select("_k", F.explode(both).alias("_b")).select("_k", "_b.*").select(
        "_k", "_n", "tb", F.posexplode_outer("ta").alias("_pa", "_na")).select(
        "_k", "_n", "_pa", "_na", F.posexplode_outer("tb").alias("_pb", "_nb"))
    first = _first_place(pairs, ["_n", "_na", "_nb"], "_k", "_pa", "_pb", span=span)
    links = first.select("*", *[F.element_at(F.array(*[F.lit(b[i]) for b in bridges]), F.col("_n")).alias(name)
                                for i, name in enumerate(("bridge", "la", "lb"))])
    for side in ("a", "b"):
        d = dims.select(F.col("list").alias("_dl"), F.col("name").alias("_dn"), F.col("_id").alias(f"_{side}"))
        links = links.join(d, (links[f"l{side}"] == d["_dl"]) & links[f"_n{side}"].eqNullSafe(d["_dn"])).drop(
            "_dl", "_dn")
    return links.select("bridge", "_a", "_b", "_k", F.col("_p0").alias("_pa"), F.col("_p1").alias("_pb"))


def normalise(raw: DataFrame, row_key: str, lists: dict | None = None, bridges: list | None = None,
              keep_null: bool = True, drop_empty: bool = False,
              buckets: int | None = None) -> NormalisedTables:
    """Raw documents -> the 8 tables: 4 dimensions, 3 bridges, Document.

    ``row_key`` is the explicit first-seen order of the raw rows (the raw
    table has no order of its own).  All list columns are exploded in one
    scan and the pairs of all bridges in another; the four dimensions are
    numbered in one ``dense_ids`` pass (partitioned by list) and the three
    bridges in another; the document table's id lists come from one lookup
    join and one aggregation, are written once and numbered lazily.  Tables are built on first access (see
    ``NormalisedTables``).
    """
    lists = lists or DOCUMENT_LISTS
    bridges = bridges or BRIDGES
    memo: dict = {}

    def span():
        if "span" not in memo:
            memo["span"] = _span(raw, row_key, list(lists))
        return memo["span"]

    def items() -> DataFrame:
        if "items" not in memo:
            memo["items"] = explode_lists(raw, row_key, list(lists))
        return memo["items"]

    def dims() -> DataFrame:
        if "dims" not in memo:
            firsts = _first_names(items(), row_key, keep_null, drop_empty, span())
            memo["dims"] = materialize(
                dense_ids(firsts, ["_k", "_p"], id_col="_id", buckets=buckets, partition_by=["list"])
                .select("list", "name", "_id"), "dims")  # small, and read by every other table
        return memo["dims"]

    def dim(col: str):
        _, name_col, id_col = lists[col]
        return lambda: dims().where(F.col("list") == col).select(
            F.col("name").alias(name_col), F.col("_id").alias(id_col))

    def all_bridges() -> DataFrame:
        if "bridges" not in memo:
            links = _bridge_links(raw, dims(), row_key, bridges, span())
            memo["bridges"] = dense_ids(
                links, ["_k", "_pa", "_pb"], id_col="_bid", buckets=buckets,
                partition_by=["bridge"]).select("bridge", "_a", "_b", "_bid")
        return memo["bridges"]

    def one_bridge(bname: str, la: str, lb: str, bid: str):
        return lambda: all_bridges().where(F.col("bridge") == bname).select(
            F.col("_a").alias(lists[la][2]), F.col("_b").alias(lists[lb][2]), F.col("_bid").alias(bid))

    def document_lists() -> DataFrame:
        if "doc" not in memo:
            # exploded again from dealt rows: the rows move once, not their items
            dealt = _dealt(raw, row_key)
            ids = all_id_lists(_items(dealt, row_key, list(lists)), dims(), row_key,
                               {col: id_col for col, (_d, _n, id_col) in lists.items()})
            doc = dealt.drop(*lists.keys()).join(ids, row_key, "left")
            # written once, read by every consumer
            memo["doc"] = materialize(doc, "document")
        return memo["doc"]

    def document() -> DataFrame:
        doc = document_lists()
        return dense_ids(doc, [row_key], id_col="document_ID", buckets=_ranges(doc, buckets))

    build: dict = {}
    for col, (dim_name, _n, _i) in lists.items():
        build[dim_name] = dim(col)
    for bname, la, lb, bid in bridges:
        build[bname] = one_bridge(bname, la, lb, bid)
    build["Document"] = document
    return NormalisedTables(build, list(build), document_lists)


def _only_new(found: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``found`` whose keys (NULL = NULL) are not in ``stored``.

    The stored table is first cut to the keys of the delta, a semi join that
    broadcasts the delta while that is small, so it is read but not shuffled.
    """
    def same(a: DataFrame, b: DataFrame):
        return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b["_n_" + k]) for k in keys])

    mine = found.select(*[F.col(k).alias("_n_" + k) for k in keys])
    known = stored.select(*keys).join(mine, same(stored, mine), "left_semi").distinct()
    known = known.select(*[F.col(k).alias("_n_" + k) for k in keys])
    return found.join(known, same(found, known), "left_anti")


def _numbered_on(fresh: DataFrame, stored: DataFrame, group: str, order: list[str], id_col: str) -> DataFrame:
    """``fresh`` with ids that continue from the highest stored one of its group, in ``order``."""
    top = stored.groupBy(F.col(group).alias("_g")).agg(F.max(id_col).alias("_top"))  # one row per table
    drawn = dense_ids(fresh, order, id_col="_drawn", partition_by=[group])
    return drawn.join(top, drawn[group] == top["_g"], "left").withColumn(
        id_col, F.coalesce("_top", F.lit(0)) + F.col("_drawn")).drop("_g", "_top", "_drawn")


def normalise_more(delta: DataFrame, existing, row_key: str, lists: dict | None = None, bridges: list | None = None,
                   keep_null: bool = True, drop_empty: bool = False) -> NormalisedTables:
    """The rows that further raw documents add to the 8 tables; ids that were given stay.

    ``existing`` maps the 8 table names to the tables as they are (as
    ``normalise`` or earlier deltas wrote them).  Names and pairs that they
    hold keep their ids; new ones get the next ids in the delta's first-seen
    order.  So appending to the tables of a base run gives what one run over
    the base's rows followed by the delta's would.  Only the delta is
    exploded; stored tables are read for their keys and highest ids.

    A delta row whose ``row_key`` is stored already is a changed document: its
    Document row comes with its old ``document_ID`` (``merge_tables``
    replaces it); names and pairs that it no longer states stay.
    """
    lists = lists or DOCUMENT_LISTS
    bridges = bridges or BRIDGES
    memo: dict = {}

    def span():
        if "span" not in memo:
            memo["span"] = _span(delta, row_key, list(lists))
        return memo["span"]

    def stored_dims() -> DataFrame:
        return reduce(DataFrame.unionByName, [
            existing[name].select(F.lit(col).alias("list"), F.col(n).alias("name"), F.col(i).alias("_id"))
            for col, (name, n, i) in lists.items()])

    def stored_bridges() -> DataFrame:
        return reduce(DataFrame.unionByName, [
            existing[name].select(F.lit(name).alias("bridge"), F.col(lists[la][2]).alias("_a"),
                                  F.col(lists[lb][2]).alias("_b"), F.col(bid).alias("_bid"))
            for name, la, lb, bid in bridges])

    def items() -> DataFrame:
        if "items" not in memo:
            memo["items"] = explode_lists(delta, row_key, list(lists))
        return memo["items"]

    def new_dims() -> DataFrame:
        if "dims" not in memo:
            fresh = _only_new(_first_names(items(), row_key, keep_null, drop_empty, span()), stored_dims(),
                              ["list", "name"])
            memo["dims"] = materialize(_numbered_on(fresh, stored_dims(), "list", ["_k", "_p"], "_id")
                                       .select("list", "name", "_id"), "dims-delta")
        return memo["dims"]

    def all_dims() -> DataFrame:
        return stored_dims().unionByName(new_dims())

    def new_bridges() -> DataFrame:
        if "bridges" not in memo:
            links = materialize(_bridge_links(delta, all_dims(), row_key, bridges, span()), "links-delta")
            fresh = _only_new(links, stored_bridges(), ["bridge", "_a", "_b"])
            memo["bridges"] = materialize(_numbered_on(fresh, stored_bridges(), "bridge", ["_k", "_pa", "_pb"], "_bid")
                                          .select("bridge", "_a", "_b", "_bid"), "bridges-delta")
        return memo["bridges"]

    def document_lists() -> DataFrame:
        if "doc" not in memo:
            dealt = _dealt(delta, row_key)
            ids = all_id_lists(_items(dealt, row_key, list(lists)), all_dims(), row_key,
                               {col: id_col for col, (_d, _n, id_col) in lists.items()})
            memo["doc"] = materialize(dealt.drop(*lists.keys()).join(ids, row_key, "left"), "document-delta")
        return memo["doc"]

    def document() -> DataFrame:
        doc, stored = document_lists(), existing["Document"].select(F.col(row_key).alias("_rk"), "document_ID")
        given = stored.join(doc.select(F.col(row_key).alias("_dk")), F.col("_rk") == F.col("_dk"), "left_semi")
        changed = doc.join(given, doc[row_key] == given["_rk"]).drop("_rk")
        fresh = _only_new(doc, existing["Document"], [row_key])
        fresh = dense_ids(fresh, [row_key], id_col="document_ID", buckets=_ranges(doc),
                          start=max_id(existing["Document"], "document_ID") + F.lit(1))
        return changed.unionByName(fresh)

    build: dict = {}
    for col, (name, n, i) in lists.items():
        build[name] = lambda col=col, n=n, i=i: new_dims().where(F.col("list") == col).select(
            F.col("name").alias(n), F.col("_id").alias(i))
    for name, la, lb, bid in bridges:
        build[name] = lambda name=name, la=la, lb=lb, bid=bid: new_bridges().where(F.col("bridge") == name).select(
            F.col("_a").alias(lists[la][2]), F.col("_b").alias(lists[lb][2]), F.col("_bid").alias(bid))
    build["Document"] = document
    return NormalisedTables(build, list(build), document_lists)


def merge_tables(existing, added, row_key: str) -> dict[str, DataFrame]:
    """The 8 tables with the rows of ``normalise_more``: appended, and documents of the same key replaced."""
    out = {}
    for name in added:
        kept = existing[name]
        if name == "Document":
            keys = added[name].select(F.col(row_key).alias("_dk"))
            kept = kept.join(keys, kept[row_key] == keys["_dk"], "left_anti")
        out[name] = kept.unionByName(added[name])
    return out


def _expand(pairs: str, mult: F.Column | None = None, keep_nulls: bool = True) -> F.Column:
    """Array of (name, n) structs -> array with each name repeated n (x mult) times, sorted."""
    arr = F.sort_array(F.col(pairs))
    if not keep_nulls:
        arr = F.filter(arr, lambda e: e["name"].isNotNull())
    rep = (lambda e: F.array_repeat(e["name"], (e["n"] * mult).cast("int"))) if mult is not None else \
        (lambda e: F.array_repeat(e["name"], e["n"].cast("int")))
    return F.flatten(F.transform(arr, rep))


def _counted(pairs: str, mult: F.Column, keep_nulls: bool = True) -> F.Column:
    """Array of (name, n) structs, sorted, each n times ``mult``."""
    arr = F.sort_array(F.col(pairs))
    if not keep_nulls:
        arr = F.filter(arr, lambda e: e["name"].isNotNull())
    return F.transform(arr, lambda e: F.struct(e["name"].alias("name"), (e["n"] * mult).alias("n")))


def _per_product(bridge_df: DataFrame, dim: DataFrame, dim_id: str, dim_name: str, out: str) -> DataFrame:
    """(Product_ID, [(name, links)], total links) for one bridge, inner-joined to its dimension.

    Links are counted per (product, name) first - a partially aggregated
    groupBy that spreads a hot product over its names - so the list
    collected per product holds distinct names, not links.
    """
    linked = bridge_df.select("Product_ID", dim_id).join(dim.select(dim_id, dim_name), dim_id, "inner")
    per_name = linked.groupBy("Product_ID", dim_name).agg(F.count(F.lit(1)).alias("n"))
    return per_name.groupBy("Product_ID").agg(
        F.collect_list(F.struct(F.col(dim_name).alias("name"), F.col("n"))).alias(out),
        F.sum("n").alias(f"_n_{out}"),
    )


def product_details(product: DataFrame, productcrop: DataFrame, crop: DataFrame,
                    productdisease: DataFrame, disease: DataFrame,
                    productpest: DataFrame, pest: DataFrame,
                    distinct: bool = False, keep_nulls: bool = False, counted: bool = False) -> DataFrame:
    """Per product: arrays of crop, disease and pest names.

    Same result as the inner join chain product-bridge-dimension x3 grouped by
    product, without materialising the nc*nd*np fan-out: each bridge is
    counted per (product, name) and the multiset is rebuilt with
    ``array_repeat`` (each crop name appears nd*np times per link, and so
    on); arrays come out sorted.  A product missing any of the three links
    drops out, as with inner joins; a product row listed r times multiplies
    its arrays by r, as the join would.  ``distinct=True`` gives the set
    form and ``counted=True`` sorted (name, n) structs, which a dimension's
    size bounds; NULL names are dropped unless ``keep_nulls``.  Output columns:
    Product_ID, Product_Name, crops, diseases, pests.
    """
    c = _per_product(productcrop, crop, "Crop_ID", "Crop_Name", "crops")
    d = _per_product(productdisease, disease, "Disease_ID", "Disease_Name", "diseases")
    p = _per_product(productpest, pest, "Pest_ID", "Pest_Name", "pests")
    prod = product.groupBy("Product_ID", "Product_Name").agg(F.count(F.lit(1)).alias("_r"))
    joined = prod.join(c, "Product_ID", "inner").join(d, "Product_ID", "inner").join(p, "Product_ID", "inner")
    if distinct:
        def names(arr):
            vals = F.array_sort(F.transform(F.col(arr), lambda e: e["name"]))
            return vals if keep_nulls else F.filter(vals, lambda x: x.isNotNull())
        return joined.select("Product_ID", "Product_Name", *[names(a).alias(a) for a in ("crops", "diseases", "pests")])
    shape = _counted if counted else _expand
    return joined.select(
        "Product_ID", "Product_Name",
        shape("crops", F.col("_r") * F.col("_n_diseases") * F.col("_n_pests"), keep_nulls).alias("crops"),
        shape("diseases", F.col("_r") * F.col("_n_crops") * F.col("_n_pests"), keep_nulls).alias("diseases"),
        shape("pests", F.col("_r") * F.col("_n_crops") * F.col("_n_diseases"), keep_nulls).alias("pests"),
    )


_KINDS = [("Disease_Names", "Disease_ID", "Disease_Name"), ("Crop_Names", "Crop_ID", "Crop_Name"),
          ("Pest_Names", "Pest_ID", "Pest_Name")]
_PRODUCT = "Product"


def document_details(document: DataFrame, product: DataFrame, crop: DataFrame, disease: DataFrame,
                     pest: DataFrame, detail_columns: list[str], doc_key: str = "document_ID",
                     keep_nulls: bool = True, strict: bool = False, counted: bool = False) -> DataFrame:
    """Per (product name, document columns): arrays of disease, crop and pest names.

    Same result as four ``LEFT JOIN UNNEST(SPLIT(ids))`` + dimension left
    joins grouped by Product_Name and the document columns, without the
    four-way fan-out.  The four id lists are unnested in one pass and looked
    up in one join against the four dimensions (labelled by list); names are
    counted per document and list; each count is multiplied by the product
    items with that name and the other two lists' sizes; the multiplicities
    are summed per output group and name (partial aggregation, so a group
    shared by many documents ships one row per name and map task); only then
    is each name repeated by its count and the arrays gathered per group
    (element order unspecified, as with ARRAY_AGG).  An id that is not a
    number or not in the dimension gives a NULL name (kept unless
    ``keep_nulls=False``); a NULL id list counts as one NULL element.
    ``strict=True`` ends the query at an element that is no number, as a
    plain CAST does; ``counted=True`` gives sorted (name, n) structs, which a
    dimension's size bounds, instead of every name n times.
    Output: Product_Name, detail columns, Disease_Names, Crop_Names, Pest_Names.
    """
    lists = [(_PRODUCT, "Product_ID")] + [(out, id_col) for out, id_col, _ in _KINDS]
    dims = [product.select(F.lit(_PRODUCT).alias("kind"), F.col("Product_ID").alias("_did"),
                           F.col("Product_Name").alias("name"))]
    for (out, id_col, name_col), d in zip(_KINDS, (disease, crop, pest)):
        dims.append(d.select(F.lit(out).alias("kind"), F.col(id_col).alias("_did"), F.col(name_col).alias("name")))
    dim_all = reduce(DataFrame.unionByName, dims)

    document = _dealt(document, doc_key)
    per_list = document.select(doc_key, F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(c).alias("ids")) for k, c in lists])).alias("_l"))
    items = per_list.select(
        doc_key, F.col("_l.kind").alias("kind"),
        F.explode_outer(F.split(F.col("_l.ids"), ",")).alias("_e"),
    ).withColumn("_eid", F.expr("try_cast(_e AS BIGINT)"))
    if strict:
        items = items.withColumn("_eid", F.when(F.col("_e").isNotNull() & F.col("_eid").isNull(), F.raise_error(
            F.concat(F.lit("not an id: "), F.col("_e"))).cast("long")).otherwise(F.col("_eid")))
    named = items.join(dim_all.withColumnRenamed("kind", "_dk"),
                       (items["kind"] == F.col("_dk")) & (items["_eid"] == F.col("_did")), "left")
    counts = named.groupBy(doc_key, "kind", "name").agg(F.count(F.lit(1)).alias("n"))
    if doc_key in detail_columns:
        return _details_by_document(document, counts, detail_columns, doc_key, keep_nulls, counted)
    # list sizes per document as window sums: one exchange on the document
    # key, which the product / name self-join below then reuses
    per_doc = Window.partitionBy(doc_key)
    counts = counts.select("*", *[
        F.sum(F.when(F.col("kind") == out, F.col("n"))).over(per_doc).alias(f"_n_{out}") for out, _, _ in _KINDS
    ])
    prod = counts.where(F.col("kind") == _PRODUCT).select(
        doc_key, F.col("name").alias("Product_Name"), F.col("n").alias("_k"))
    long = counts.where(F.col("kind") != _PRODUCT)
    other = {
        "Disease_Names": F.col("_n_Crop_Names") * F.col("_n_Pest_Names"),
        "Crop_Names": F.col("_n_Disease_Names") * F.col("_n_Pest_Names"),
        "Pest_Names": F.col("_n_Disease_Names") * F.col("_n_Crop_Names"),
    }
    mult = F.col("n") * F.col("_k")
    for out, _, _ in _KINDS:
        mult = F.when(F.col("kind") == out, mult * other[out]).otherwise(mult)
    contrib = (
        long.join(prod, doc_key)
        .join(document.select(doc_key, *[c for c in detail_columns if c != doc_key]), doc_key)
        .select(*detail_columns, "Product_Name", "kind", "name", mult.alias("n"))
    )
    group = ["Product_Name", *detail_columns]
    per_name = contrib.groupBy(*group, "kind", "name").agg(F.sum("n").alias("n"))
    if not keep_nulls:
        per_name = per_name.where(F.col("name").isNotNull())
    if counted:
        return per_name.groupBy(*group).agg(*[
            F.sort_array(F.collect_list(F.when(F.col("kind") == out, F.struct("name", "n")))).alias(out)
            for out, _, _ in _KINDS])
    # each name expanded on its own row (codegen'd array_repeat), then one
    # array per kind gathered per group; NULL arrays of the other kinds are
    # skipped by collect_list
    per_name = per_name.withColumn("_rep", F.array_repeat(F.col("name"), F.col("n").cast("int")))
    grouped = per_name.groupBy(*group).agg(*[
        F.flatten(F.collect_list(F.when(F.col("kind") == out, F.col("_rep")))).alias(out) for out, _, _ in _KINDS
    ])
    return grouped


def _details_by_document(document: DataFrame, counts: DataFrame, detail_columns: list[str], doc_key: str,
                         keep_nulls: bool, counted: bool) -> DataFrame:
    """``document_details`` where the document key is a group column, so that no group spans two documents.

    ``counts`` (doc_key, kind, name, n) is gathered once per document into a
    short array per list; its products are exploded and each array is
    expanded in its row.  Everything stays in the task of the document.
    """
    kinds = [out for out, _, _ in _KINDS]
    gathered = counts.where(F.col(doc_key).isNotNull()).groupBy(doc_key).agg(
        F.collect_list(F.struct("kind", "name", "n")).alias("_all"))
    shown = [c for c in detail_columns if c != doc_key]
    listed = document.groupBy(F.col(doc_key).alias("_dk"), *shown).agg(F.count(F.lit(1)).alias("_r"))

    def of(kind: str) -> F.Column:
        return F.transform(F.filter("_all", lambda e: e["kind"] == kind), lambda e: F.struct(
            e["name"].alias("name"), e["n"].alias("n"))).alias(kind)

    lists = gathered.select(doc_key, *[of(k) for k in (_PRODUCT, *kinds)])
    sizes = {k: F.aggregate(k, F.lit(0).cast("long"), lambda total, e: total + e["n"]) for k in kinds}
    lists = lists.select("*", *[c.alias(f"_n_{k}") for k, c in sizes.items()])
    per = lists.join(listed, lists[doc_key] == listed["_dk"]).select(
        *detail_columns, "_r", *kinds, *[f"_n_{k}" for k in kinds], F.explode(_PRODUCT).alias("_p"))
    shape = _counted if counted else _expand
    base = F.col("_r") * F.col("_p")["n"]
    out = []
    for k in kinds:
        a, b = [F.col(f"_n_{o}") for o in kinds if o != k]
        out.append(shape(k, base * a * b, keep_nulls).alias(k))
    per = per.select(F.col("_p")["name"].alias("Product_Name"), *detail_columns, *out)
    if not keep_nulls:  # a group without any name is no group
        per = per.where(sum((F.size(k) for k in kinds), F.lit(0)) > 0)
    return per
