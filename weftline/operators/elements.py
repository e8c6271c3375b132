"""Lines, pages, outlines and chunks of texts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import materialize

# Letter pairs whose loss shows a damaged text layer, per pair of the control letters.
PAIR_RATIOS = {"ti": 0.8219, "fi": 0.2329, "ff": 0.1199, "fl": 0.0068, "ct": 0.4452, "st": 0.3938, "tt": 0.1301}
LEAST_EXPECTED, LEAST_RETENTION = 5.0, 0.35


def pair_count(text: Column, pair: str) -> Column:
    """Occurrences of two letters at every position, overlapping ones too."""
    return F.regexp_count(text, F.lit(f"(?={pair})"))


def text_health(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, control, judged, retention, degraded) of each text; retention is null where nothing can be judged."""
    t = F.lower(F.coalesce(F.col(text), F.lit("")))
    d = docs.select(id_col, (pair_count(t, "th") + pair_count(t, "er")).alias("control"), *[pair_count(t, p).alias(p) for p in PAIR_RATIOS])
    judged = [F.when(F.col("control") * r >= LEAST_EXPECTED, F.floor(F.col(p) / (F.col("control") * r) * 10000 + 0.5) / 10000) for p, r in PAIR_RATIOS.items()]
    d = d.withColumn("kept", F.filter(F.array(*judged), lambda x: x.isNotNull()))
    retention = F.array_min("kept")
    return d.select(id_col, "control", F.size("kept").alias("judged"), retention.alias("retention"), F.coalesce(retention < LEAST_RETENTION, F.lit(False)).alias("degraded"))


def lines(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, line_no, line) of every line; a null text has none."""
    return docs.select(id_col, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))


def running_page(ls: DataFrame, id_col: str, divider: str = r"^(?:-+ *)?Page (\d+)(?: of \d+)?(?: *-+)?$") -> DataFrame:
    """(id, line_no, line, page): the page named by the last divider before a line; dividers are left out."""
    mark = F.when(F.trim("line").rlike(divider), F.regexp_extract(F.trim("line"), divider, 1).cast("int"))
    w = f"last_value(mark, true) OVER (PARTITION BY {id_col} ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return ls.withColumn("mark", mark).withColumn("page", F.expr(w)).filter("mark IS NULL").drop("mark")


def recognised_headings(ls: DataFrame, id_col: str) -> DataFrame:
    """(id, line_no, heading, level, number): numbered lines and short lines in capitals, without furniture."""
    t = F.trim("line")
    number = X.leading_number(t)["number"]
    caps = (F.length(t) <= 48) & t.rlike(r"\p{L}") & (t == F.upper(t)) & ~X.is_admonition(t)
    # Furniture is asked for last: few lines are headings otherwise.
    heads = ls.filter(t.rlike("^[0-9]") | caps).withColumn("number", number).filter((F.col("number").isNotNull() | caps) & ~X.is_furniture(t))
    level = F.when(F.col("number").isNotNull(), F.size(F.split("number", r"\."))).otherwise(1)
    return heads.select(id_col, "line_no", t.alias("heading"), level.alias("level"), "number")


#: Levels up to which an outline is found by windows.
WINDOW_LEVELS = 9


def outline(heads: DataFrame, id_col: str) -> DataFrame:
    """``heads`` with ``parent`` (line of the nearest heading above with a lower level) and ``end_line``.

    The parent is the greatest of the last lines of each lower level, the end the line before the next
    heading that is no descendant; both are running windows of one sort, whatever the text's length.
    Texts with levels above WINDOW_LEVELS are read with a stack of open headings instead.
    """
    cols = [id_col, "line_no", "heading", "level", "number"]
    heads = materialize(heads.select(*cols), "headings")  # few beside the lines they were found in
    if heads.filter(F.col("level") > WINDOW_LEVELS).isEmpty():
        return _windowed(heads, id_col)
    marked = heads.select(*cols).withColumn("_deep", F.expr(f"max(level) OVER (PARTITION BY {id_col})") > WINDOW_LEVELS)
    kind = dict(heads.dtypes)
    schema = ", ".join(f"{c} {kind[c]}" for c in cols) + ", parent int, end_line int"
    deep = marked.filter("_deep").select(*cols).groupBy(id_col).applyInPandas(_stacked, schema)
    return _windowed(marked.filter("NOT _deep"), id_col).unionByName(deep)


def _windowed(heads: DataFrame, id_col: str) -> DataFrame:
    back = f"OVER (PARTITION BY {id_col} ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ahead = f"OVER (PARTITION BY {id_col} ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    seen = {k: F.expr(f"max(CASE WHEN level = {k} THEN line_no END) {back}") for k in range(1, WINDOW_LEVELS)}
    coming = {k: F.expr(f"min(CASE WHEN level = {k} THEN line_no END) {ahead}") for k in range(1, WINDOW_LEVELS + 1)}
    d = heads.withColumns({f"b{k}": c for k, c in seen.items()} | {f"a{k}": c for k, c in coming.items()})
    level = F.col("level")
    parent = F.greatest(*[F.when(level > k, F.col(f"b{k}")) for k in range(1, WINDOW_LEVELS)])
    following = F.least(*[F.when(level >= k, F.col(f"a{k}")) for k in range(1, WINDOW_LEVELS + 1)])
    return d.select(id_col, "line_no", "heading", "level", "number", parent.alias("parent"), (following - 1).alias("end_line"))


def _stacked(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("line_no").reset_index(drop=True)
    level, line = pdf["level"].tolist(), pdf["line_no"].tolist()
    parent: list[int | None] = [None] * len(line)
    end: list[int | None] = [None] * len(line)
    held: list[int] = []
    for i, v in enumerate(level):
        while held and level[held[-1]] >= v:
            end[held.pop()] = line[i] - 1
        parent[i] = line[held[-1]] if held else None
        held.append(i)
    return pdf.assign(parent=pd.array(parent, dtype="Int32"), end_line=pd.array(end, dtype="Int32"))


def overlapping_chunks(docs: DataFrame, id_col: str, text: str, size: int = 15_000, overlap: int = 1_500) -> DataFrame:
    """(id, chunk_no, chunk): windows of ``size`` characters every ``size - overlap``; a short text is one chunk."""
    n, step = F.length(text), size - overlap
    starts = F.when(n <= size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n - 1, F.lit(step)))
    d = docs.filter(n > 0).select(id_col, text, F.posexplode(starts).alias("chunk_no", "start"))
    return d.select(id_col, "chunk_no", F.col(text).substr(F.col("start") + 1, F.lit(size)).alias("chunk"))


def layout(pages: DataFrame, keys: list[str]) -> DataFrame:
    """The layout archetype of each page of elements (type, text, width, image).

    In order: a table; images with little text (hero); text only (documentary); three images or more
    (grid); one wide text (content_caption); otherwise split. Text is that of narrative and list elements.
    """
    text = F.when(F.col("type").isin("Title", "ListItem", "Text"), F.length("text")).otherwise(0)
    g = pages.groupBy(*keys).agg(F.count_if(F.col("type") == "Table").alias("tables"), F.count_if(F.col("type") == "Image").alias("images"), F.sum(text).alias("chars"), F.max(F.when(F.col("type") == "Image", F.col("width")) / 1280.0).alias("ratio"))
    kind = F.when(F.col("tables") > 0, "table").when((F.col("images") == 1) & (F.col("chars") < 200), "hero").when(F.col("images") == 0, "documentary").when(F.col("images") >= 3, "grid").when(F.col("ratio") > 0.6, "content_caption").otherwise("split")
    return g.select(*keys, kind.alias("layout"))


def upsert_verdicts(old: DataFrame, new: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, verdict): what a write of ``new`` rows does to ``old`` ones; rows without a key raise.

    With a vector a row is written; without one an existing key is left alone and a new one is
    written without a vector. Untouched keys have no row.
    """
    checked = new.withColumn(key, F.when(F.coalesce(F.col(key), F.lit("")) == "", F.raise_error(F.lit("a chunk needs an id"))).otherwise(F.col(key)))
    have = old.select(F.col(key).alias("_k")).distinct()
    j = checked.join(have, F.col(key) == F.col("_k"), "left")
    return j.select(key, F.when(F.col(vector).isNotNull(), "written").when(F.col("_k").isNotNull(), "skipped_would_strip_vector").otherwise("written_without_vector").alias("verdict"))


def upserted(old: DataFrame, new: DataFrame, key: str, vector: str) -> DataFrame:
    """The state after the write: one row per key, an existing row kept where the new one has no vector.

    Of new rows with one key one with a vector stays, of these the greatest by all columns.
    """
    cols = [c for c in old.columns if c != key]
    o = old.select(key, F.struct(*cols).alias("o"))
    n = new.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(F.col(vector).isNotNull(), *cols)).alias("n"))
    j = o.join(n, key, "full_outer")
    keep = F.when(F.col("n").isNull() | (F.col("o").isNotNull() & F.col(f"n.{vector}").isNull()), F.col("o")).otherwise(F.col("n"))
    return j.select(key, keep.alias("r")).select(key, *[f"r.{c}" for c in cols])
