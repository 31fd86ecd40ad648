"""Keyword search over every column of a table.

A keyword list becomes one predicate (OR of keywords, OR of columns) on one
scan.  A keyword *table* of unbounded size is joined instead: rows and
keywords are both cut into n-gram tokens so the match is an equi-join on a
token followed by the exact ``contains`` check, never a nested loop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.columns import keyword_match
from fieldbook.session import materialize, tasks_for


def search(df: DataFrame, keywords, columns: list[str] | None = None, literal: bool = False) -> DataFrame:
    """Rows where any column, cast to string, contains any keyword.

    ``keywords`` must be a list (a bare string is refused, as in the
    reference); an empty list or a None keyword raises ``ValueError``.
    With ``literal=False`` the keyword is a LIKE pattern body (``%``/``_``
    are wildcards), as in ``LIKE '%kw%'``.
    """
    if isinstance(keywords, str) or not isinstance(keywords, (list, tuple)):
        raise ValueError("give the keywords as a list")
    cols = columns or list(df.columns)
    return df.where(keyword_match(cols, keywords, literal))


def search_one(df: DataFrame, keyword: str, columns: list[str] | None = None, literal: bool = False) -> DataFrame:
    """One keyword."""
    if keyword is None:
        raise ValueError("keyword must not be None")
    return search(df, [keyword], columns, literal)


_GRAM = 3
_TASK_CHARS = 1 << 20  # characters of cells dealt to one task
_SENT_CHARS = 200_000  # keywords are broadcast up to so many characters


def _grams(text: Column, n: int) -> Column:
    """Distinct substrings of length ``n`` of a text (empty for shorter texts).

    The text is cut into characters once and neighbours are joined, so the
    work is linear in its length.
    """
    chars = F.split(text, "")
    idx = F.sequence(F.lit(0), F.greatest(F.size(chars) - n, F.lit(0)))
    subs = F.transform(idx, lambda i: F.concat(*[F.coalesce(F.get(chars, i + k), F.lit("")) for k in range(n)]))
    return F.array_distinct(F.filter(subs, lambda g: F.length(g) == n))


def _factors(pattern: Column) -> Column:
    """The literal stretches of a LIKE pattern, between its wildcards and with escapes undone."""
    raw = F.regexp_extract_all(pattern, F.lit(r"((?:[^%_\\]++|\\.)++)"), F.lit(1))
    return F.transform(raw, lambda f: F.regexp_replace(f, r"\\(.)", "$1"))


def _patterns(keywords: DataFrame, keyword_col: str, literal: bool) -> DataFrame:
    """(_kw, _n, _gs): the distinct keywords, the gram length that fits their longest factor (0: none) and their grams."""
    kw = (keywords.select(F.col(keyword_col).cast("string").alias("_kw"))
          .where(F.col("_kw").isNotNull() & (F.length("_kw") > 0)).distinct())
    factors = F.array("_kw") if literal else _factors(F.col("_kw"))
    kw = kw.select("_kw", factors.alias("_f"))
    longest = F.coalesce(F.array_max(F.transform("_f", lambda f: F.length(f))), F.lit(0))
    kw = kw.withColumn("_n", F.least(longest, F.lit(_GRAM)))
    # factors shorter than _n have no gram of that length
    def cut(n: int) -> Column:
        return F.array_distinct(F.flatten(F.transform("_f", lambda f: _grams(f, n))))

    grams = F.when(F.col("_n") == 1, cut(1)).when(F.col("_n") == 2, cut(2)).when(F.col("_n") == 3, cut(3))
    return kw.select("_kw", "_n", grams.alias("_gs"))


def search_table(df: DataFrame, keywords: DataFrame, row_id: str, keyword_col: str = "keyword",
                 columns: list[str] | None = None, literal: bool = True) -> DataFrame:
    """(row_id, keyword) for every row with a cell that contains a keyword of a keyword table.

    An inverted-index join, exact and without a nested loop or a broadcast
    of the (unbounded) keyword table or rows; only keywords of
    ``_SENT_CHARS`` characters in all are broadcast.  A keyword is keyed by one n-gram of
    its literal text: its *rarest* trigram, by row counts from one partially
    aggregated groupBy, or the rarest 2- or 1-gram if it has no longer
    stretch.  It meets the rows that hold this gram and the match is
    confirmed there.  Rows are cut only into grams of the lengths that the
    keywords need, and only grams that some keyword holds are shuffled.

    ``literal=True``: keywords are plain substrings.  ``literal=False``: they
    are bodies of LIKE patterns, as in ``cell LIKE '%kw%'``, with ``%``,
    ``_`` and the escape ``\\``; grams come from the stretches between
    wildcards and ``like`` confirms on each cell.  A pattern of wildcards
    alone matches by length: it meets each row with a cell of that many
    characters.  Cells are the columns cast to string; a NULL cell matches
    nothing, NULL and empty keywords are left out.
    """
    cols = columns or [c for c in df.columns if c != row_id]
    cells = F.array_compact(F.array(*[F.col(c).cast("string") for c in cols]))
    rows = _dealt(df.select(row_id, cells.alias("_cells")), row_id)
    kw = materialize(_patterns(keywords, keyword_col, literal), "keywords")  # read once for each use below
    # one row for each gram length, 0 to 3, and the characters of its keywords
    lengths = sorted(kw.groupBy("_n").agg(F.sum(F.length("_kw")).alias("_c")).collect())
    if literal:
        found = F.exists("_cells", lambda c: c.contains(F.col("_kw")))
    else:
        found = F.exists("_cells", lambda c: F.like(c, F.concat(F.lit("%"), "_kw", F.lit("%"))))
    hits = []
    for n, chars in lengths:
        if n == 0:
            hits.append(_by_length(rows, kw, row_id, chars).distinct())
            continue
        held = kw.where(F.col("_n") == n).select("_kw", F.explode("_gs").alias("_g"))
        index = rows.select(row_id, F.explode(_grams(F.array_join("_cells", "\u0001"), n)).alias("_g"))
        known = index.join(_small_side(held.select("_g").distinct(), chars), "_g", "left_semi")
        freq = known.groupBy("_g").agg(F.count(F.lit(1)).alias("_f"))
        # a keyword with a gram that no row has cannot match: only those with all their grams found are keyed
        key = held.join(freq, "_g", "left").groupBy("_kw").agg(
            F.min_by("_g", F.struct(F.coalesce("_f", F.lit(0)), "_g")).alias("_g"))
        candidates = index.join(_small_side(key, chars), "_g").select(row_id, "_kw")
        if not (literal and n < _GRAM):  # a short literal keyword is its own gram
            candidates = candidates.join(rows.hint("merge"), row_id).where(found)
        # a keyword has one length, so the pairs of two lengths differ
        hits.append(candidates.select(row_id, "_kw").distinct())
    if not hits:
        hits = [rows.select(row_id, F.lit("").alias("_kw")).limit(0)]
    return reduce(DataFrame.unionByName, hits).withColumnRenamed("_kw", keyword_col)


def _dealt(rows: DataFrame, row_id: str) -> DataFrame:
    """Rows dealt by their id, so many to a task that its cells have about ``_TASK_CHARS`` characters.

    A table of short texts is a small file that one task would read, and the
    grams and matches made from it are many times its size.
    """
    chars = rows.agg(F.sum(F.aggregate("_cells", F.lit(0), lambda n, c: n + F.length(c)))).first()[0]
    return rows.repartition(tasks_for(rows.sparkSession, chars, _TASK_CHARS), row_id)


def _small_side(keys: DataFrame, chars: int) -> DataFrame:
    """The keyword side of a join with grams: broadcast while all its keywords are short, else met by sorting.

    Spark would judge by the sizes of compressed files, and might send the
    grams of all rows to the driver.
    """
    return F.broadcast(keys) if chars <= _SENT_CHARS else keys.hint("merge")


def _by_length(rows: DataFrame, kw: DataFrame, row_id: str, chars: int) -> DataFrame:
    """Matches of patterns without a literal character: a cell needs one character per underscore."""
    bare = kw.where(F.col("_n") == 0).select("_kw", F.length(F.regexp_replace("_kw", "%", "")).alias("_m"))
    top = bare.agg(F.max("_m").alias("_top")).scalar()
    sized = rows.where(F.size("_cells") > 0).select(
        row_id, F.array_max(F.transform("_cells", lambda c: F.length(c))).alias("_len"))
    return sized.select(row_id, F.explode(F.sequence(F.lit(0), F.least("_len", top))).alias("_m")).join(
        _small_side(bare, chars), "_m").select(row_id, "_kw")
