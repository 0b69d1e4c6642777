"""Line de-duplication by overlapping windows of three lines (operator 8).

Every run of three consecutive lines of a text is a window, known by a 128-bit hash of the lines'
hashes. So that a passage of few but long lines is found too, a line of more than ``LONG`` words
is a window by itself, and so are two lines that have more than that only together. Windows
without any word do not count. A window that occurs more than once anywhere stays where it
occurs first (by id, then place; null ids first); the lines that its later occurrences cover are
removed, overlapping ones merged. Every removed line has an equal line that stays.

Only DataFrame functions. Windows are counted before they meet, and occurrences are joined to
the repeated windows, a join whose hot windows Spark can split; no window's occurrences are ever
gathered. Null texts stay null, and texts of one or two short lines are never cut. Rows with the
same id and text are cut alike; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelda.llm.tables import fresh_names, quoted, stored

WINDOW = 3
#: A passage of more words than this is a window even in one or two lines.
LONG = 50
SPACES = r"[\x20\x09-\x0D]+"


def _word_count(line: Column) -> Column:
    return F.size(F.filter(F.split(line, SPACES), lambda w: w != ""))


def line_windows(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW, long: int = LONG) -> DataFrame:
    """(id, version, pos, size, a, b): the windows of every text; (a, b) is a window's hash and
    version tells apart texts with the same id."""
    text = F.col(text_col).cast("string")
    lines = F.transform(
        F.split(text, "\n"),
        lambda x: F.struct(
            F.xxhash64(x).alias("a"),
            F.xxhash64(F.lit("second"), x).alias("b"),
            _word_count(x).alias("n"),
        ),
    )
    per_text = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), lines.alias("l")).where(
        F.col("l").isNotNull()
    )

    def at(i: Column, k: int, part: str) -> Column:
        return F.get(F.col("l"), i + k)[part]

    def made(i: Column, size: int, counts: Column) -> Column:
        """The window of a size at place i, null where it is none."""
        return F.when(
            (i + size <= F.size("l")) & counts,
            F.struct(
                i.alias("pos"),
                F.lit(size).alias("size"),
                F.xxhash64(*(at(i, k, "a") for k in range(size))).alias("a"),
                F.xxhash64(*(at(i, k, "b") for k in reversed(range(size)))).alias("b"),
            ),
        )

    def words(i: Column, size: int) -> Column:
        total = at(i, 0, "n")
        for k in range(1, size):
            total = total + at(i, k, "n")
        return total

    def of(i: Column) -> Column:
        return F.array(
            made(i, window, words(i, window) > 0),
            made(i, 1, at(i, 0, "n") > long),
            made(i, 2, words(i, 2) > long),
        )

    places = F.sequence(F.lit(0), F.size("l") - 1)
    every = F.filter(F.flatten(F.transform(places, of)), lambda w: w.isNotNull())
    return per_text.select("id", "version", F.explode(every).alias("w")).select("id", "version", "w.*")


def later_occurrences(found: DataFrame) -> DataFrame:
    """The windows that are not the first of their kind."""
    place = F.struct("id", "version", "pos")
    repeated = (
        found.groupBy("a", "b", "size")
        .agg(F.min(place).alias("first"), F.count("*").alias("times"))
        .where("times > 1")
        .select("a", "b", "size", "first")
    )
    # Merge joins at every size: the same plan for a small and a large corpus.
    later = stored(repeated, "repeated-lines").hint("merge")
    return found.join(later, ["a", "b", "size"]).where(
        ~place.eqNullSafe(F.col("first"))
    )


def dedupe_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    long: int = LONG,
    count_cols: tuple[str, str] | None = None,
) -> DataFrame:
    """All rows, with the covered lines removed from their texts; a text that loses all its lines
    is empty. ``count_cols`` names two more columns: lines before, and lines removed."""
    found = stored(line_windows(docs, id_col, text_col, window, long), "line-windows")
    spans = F.transform(
        F.collect_set(F.struct("pos", "size")),
        lambda w: F.sequence(w["pos"], w["pos"] + w["size"] - 1),
    )
    covered = (
        later_occurrences(found)
        .groupBy("id", "version")
        .agg(F.array_distinct(F.flatten(spans)).alias("covered"))
    )
    hit, cut_id, cut_version, lines_col = fresh_names(docs, "covered", "id", "version", "lines")
    text = F.col(text_col).cast("string")
    cut = stored(covered, "covered-lines").toDF(cut_id, cut_version, hit)
    joined = docs.join(
        cut.hint("merge"),
        F.col(id_col).eqNullSafe(F.col(cut_id)) & (F.xxhash64(text) == F.col(cut_version)),
        "left",
    ).withColumn(lines_col, F.split(text, "\n"))
    stays = F.array_except(F.sequence(F.lit(0), F.size(lines_col) - 1), F.col(hit))
    rest = F.array_join(F.transform(stays, lambda i: F.get(F.col(lines_col), i)), "\n")
    shown = [
        F.when(F.col(hit).isNull(), text).otherwise(rest).alias(c) if c == text_col else column
        for c, column in zip(docs.columns, quoted(docs.columns))
    ]
    if count_cols:
        total = F.when(text.isNull(), 0).otherwise(F.size(lines_col)).cast("bigint")
        removed = F.coalesce(F.size(hit), F.lit(0)).cast("bigint")
        removed = F.when(F.col(hit).isNull(), F.lit(0).cast("bigint")).otherwise(removed)
        shown += [total.alias(count_cols[0]), removed.alias(count_cols[1])]
    return joined.select(shown)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_lines, n_removed and a digest of the text that stays, for every document."""
    slim = docs.select(id_col, text_col)
    cut = dedupe_lines(slim, id_col, text_col, count_cols=("n_lines", "n_removed"))
    kept = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return cut.select(id_col, "n_lines", "n_removed", F.sha2(kept.cast("binary"), 256).alias("text_sha256"))


#: Lines that stay, in DuckDB's SQL, from a relation docs(doc_id, text).
KEPT_SQL = r"""
lines AS (
  SELECT doc_id, i - 1 AS pos, l[i] AS line, l, len(l) AS n_lines
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM docs WHERE text IS NOT NULL))
), counted AS (
  SELECT doc_id, pos, line, n_lines, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM lines
), ahead AS (
  SELECT *, lead(line, 1) OVER w AS line1, lead(line, 2) OVER w AS line2,
         lead(n, 1) OVER w AS n1, lead(n, 2) OVER w AS n2
  FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), wins AS (
  SELECT doc_id, pos, 3 AS size, line || chr(10) || line1 || chr(10) || line2 AS span
  FROM ahead WHERE pos + 3 <= n_lines AND n + n1 + n2 > 0
  UNION ALL
  SELECT doc_id, pos, 1, line FROM ahead WHERE n > 50
  UNION ALL
  SELECT doc_id, pos, 2, line || chr(10) || line1 FROM ahead
  WHERE pos + 2 <= n_lines AND n + n1 > 50
), later AS (
  SELECT doc_id, pos, size FROM (
    SELECT *, row_number() OVER (PARTITION BY size, span ORDER BY doc_id, pos) AS nth FROM wins
  ) WHERE nth > 1
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + size)) AS pos FROM later
), kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(line, chr(10) ORDER BY pos) AS text
  FROM counted ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id
)"""

SQL = f"""
WITH docs AS (SELECT doc_id, text FROM documents), {KEPT_SQL}
SELECT doc_id,
       CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS BIGINT) AS n_lines,
       CAST(CASE WHEN d.text IS NULL THEN 0
                 ELSE len(string_split(d.text, chr(10))) - coalesce(n_kept, 0) END AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS text_sha256
FROM docs AS d LEFT JOIN kept USING (doc_id)
"""
