"""Merkle trees over sections and paragraphs: roots test equality, branches locate edits.

Everything is a column expression; no row leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urnalake.checks.registry import check
from urnalake.llm.common import table

# A section ends behind an empty line, a paragraph behind a line break; the breaks stay part
# of their piece, so the pieces of a text joined together are that text.
SECTION = r"(?s).+?(?:\n{2,}|\z)"
PARAGRAPH = r"[^\n]*\n|[^\n]+"
# A paragraph's pieces, the leaves, end at the first space or "e" behind their seventh code point, so
# that what is put in moves the cuts near it only; text without either is cut every 64 code points.
PIECE = r"(?s).{7,63}?[ e]|.{1,64}"
#: Rows of a range that one window sorts, on average, and sampled ids per range.
RANGE_ROWS = 500_000
SAMPLED = 8


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.transform(F.array(value), use)[0]


def tree(text: Column) -> Column:
    """The branches of a text: sections with digest and paragraphs, these with digest and pieces.

    A piece is 64 bits of its digest; a paragraph's digest covers the digests of its pieces, a
    section's those of its paragraphs. Null counts as the empty text, which has no section.
    """
    return F.transform(_all(F.coalesce(text, F.lit("")), SECTION), lambda text: _let(_paragraphs_of(text), _section))


def _paragraphs_of(section: Column) -> Column:
    return F.transform(
        _all(section, PARAGRAPH),
        lambda text: _let(F.transform(_all(text, PIECE), lambda piece: F.md5(piece.cast("binary"))), _paragraph),
    )


def _paragraph(digests: Column) -> Column:
    """Pieces are whole numbers, as Spark compares arrays of these by hash tables."""
    return F.struct(
        F.sha2(F.array_join(digests, "").cast("binary"), 256).alias("digest"),
        F.transform(digests, lambda d: F.xxhash64(d)).alias("pieces"),
    )


def _section(paragraphs: Column) -> Column:
    digests = F.array_join(_digests(paragraphs), "")
    return F.struct(F.sha2(digests.cast("binary"), 256).alias("digest"), paragraphs.alias("paragraphs"))


def root(branches: Column) -> Column:
    """The digest over a tree's section digests: equal for equal texts."""
    return F.sha2(F.array_join(_digests(branches), "").cast("binary"), 256)


def _digests(nodes: Column) -> Column:
    return F.transform(nodes, lambda n: n["digest"])


def _pieces(paragraphs: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(paragraphs, lambda p: p["pieces"])))


def _paragraphs(sections: Column) -> Column:
    return F.flatten(F.transform(sections, lambda s: s["paragraphs"]))


def _parted(a: Column, b: Column) -> Column:
    """(same, mine, theirs): nodes equal by digest from either end on, and those between them.

    Each digest is looked at twice, so that the cost goes with the number of nodes.
    """

    def equal_ahead(x: Column, y: Column) -> Column:
        found = F.array_position(F.zip_with(_digests(x), _digests(y), lambda m, n: m.eqNullSafe(n)), False)
        return F.when(found == 0, F.size(x)).otherwise((found - 1).cast("int"))

    def cut(ends: Column) -> Column:
        front = ends["front"]
        back = F.least(ends["back"], F.size(a) - front, F.size(b) - front)
        return F.struct(
            F.concat(F.slice(a, F.lit(1), front), F.slice(a, F.size(a) - back + 1, back)).alias("same"),
            F.slice(a, front + 1, F.size(a) - front - back).alias("mine"),
            F.slice(b, front + 1, F.size(b) - front - back).alias("theirs"),
        )

    return _let(F.struct(equal_ahead(a, b).alias("front"), equal_ahead(F.reverse(a), F.reverse(b)).alias("back")), cut)


def shared_pieces(a: Column, b: Column) -> Column:
    """How many different pieces two trees have in common.

    What lies below equal digests at either end is shared as a whole; only between them sections
    are opened, then paragraphs, and only the pieces of what is left are looked for.
    """

    def sections(s: Column) -> Column:
        return _let(
            F.struct(_paragraphs(s["mine"]).alias("mine"), _paragraphs(s["theirs"]).alias("theirs")),
            lambda p: _let(_parted(p["mine"], p["theirs"]), lambda q: paragraphs(s, q)),
        )

    def paragraphs(s: Column, q: Column) -> Column:
        same = _pieces(F.concat(_paragraphs(s["same"]), q["same"]))
        return F.size(F.array_union(same, F.array_intersect(_pieces(q["mine"]), _pieces(q["theirs"]))))

    return _let(_parted(a, b), sections)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else twice the pieces that two trees share over the pieces of both."""
    both = F.size(_pieces(_paragraphs(a))) + F.size(_pieces(_paragraphs(b)))
    part = _let(both, lambda n: F.when(n == 0, F.lit(1.0)).otherwise(2.0 * shared_pieces(a, b) / n))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(part)


def edits(before: Column, after: Column) -> Column:
    """Where two trees differ: (section, paragraphs) from 0, only below differing branches.

    A section that only one tree has is listed with all its paragraphs.
    """

    def differing(index: Column) -> Column:
        a, b = F.get(before, index), F.get(after, index)
        paragraphs = F.greatest(F.coalesce(F.size(a["paragraphs"]), F.lit(0)), F.coalesce(F.size(b["paragraphs"]), F.lit(0)))
        changed = F.filter(
            F.transform(F.sequence(F.lit(0), F.greatest(paragraphs - 1, F.lit(0))), lambda i: i),
            lambda i: ~F.get(a["paragraphs"], i)["digest"].eqNullSafe(F.get(b["paragraphs"], i)["digest"]),
        )
        return F.struct(index.alias("section"), changed.alias("paragraphs"))

    most = F.greatest(F.size(before), F.size(after))
    indexes = F.when(most > 0, F.sequence(F.lit(0), most - 1)).otherwise(F.array().cast("array<int>"))
    wrong = F.filter(indexes, lambda i: ~F.get(before, i)["digest"].eqNullSafe(F.get(after, i)["digest"]))
    return F.transform(wrong, differing)


def with_tree(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its Merkle ``branches`` and ``fingerprint``; columns of those names give way."""
    return df.withColumn("branches", tree(F.col(text))).withColumn("fingerprint", root(F.col("branches")))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, next_text): every row with the text of the row behind it, the last with the first.

    Rows follow each other by id, nulls last, equal ids by text. Ids may be of any type that has an
    order. They are cut into ranges at ids of a sample whose size goes with the number of rows.
    Each range is one window group, closed by a copy of the next range's first row, so no order
    over all rows is needed.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType
    count, nulls, least = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("id").isNull(), 1)), F.min("id")).first()
    wanted = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), count // RANGE_ROWS)
    # Ids whose hash is small: about SAMPLED times as many as ranges, whichever rows have them.
    small = F.xxhash64("id").cast("double") / 2.0**64 + 0.5 < min(1.0, SAMPLED * wanted / max(count, 1))
    sample = [r["id"] for r in rows.select("id").where(F.col("id").isNotNull() & small).distinct().orderBy("id").collect()]
    cuts = ([least] if least is not None else []) + [c for c in sample[:: max(1, len(sample) // wanted)] if c != least]
    ranges = len(cuts) + bool(nulls)
    if not ranges:
        return rows.withColumn("next_text", F.lit("")).where(F.lit(False))
    literal = [F.lit(c).cast(kind) for c in cuts]
    place = F.when(F.col("id").isNull(), len(cuts) + 1).otherwise(_cuts_up_to(F.col("id"), literal))
    placed = rows.withColumn("range", place.cast("int")).withColumn("guard", F.lit(0))
    first = placed.where(F.col("id").isin(literal) | F.col("id").isNull())
    before = (F.col("range") + (ranges - 2)) % ranges + 1
    guards = first.groupBy("range").agg(F.min("text").alias("text")).select(
        F.lit(None).cast(kind).alias("id"), "text", before.cast("int").alias("range"), F.lit(1).alias("guard")
    )
    order = Window.partitionBy("range").orderBy("guard", "id", "text")
    rows = placed.unionByName(guards).withColumn("next_text", F.lead("text").over(order))
    return rows.where("guard = 0").drop("range", "guard")


def _cuts_up_to(value: Column, cuts: list[Column]) -> Column:
    """How many of the sorted cuts are not above a value: by groups of cuts first, then in one."""
    if not cuts:
        return F.lit(0)
    width = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    group = F.size(F.filter(F.array(*[g[0] for g in groups]), lambda c: c <= value))
    inside = F.size(F.filter(F.get(F.array(*[F.array(*g) for g in groups]), group - 1), lambda c: c <= value))
    return F.when(group == 0, 0).otherwise((group - 1) * width + inside)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text and its edited form (last quarter replaced from the next text) compared by tree.

    Null text counts as empty; two empty texts are alike. Rows are kept one for one, also equal
    ones; an empty table gives no rows. Ids may be null, large, text or dates. Other columns are
    not used.
    """
    rows = with_next(docs, key, text)
    n = F.char_length("text")
    tail = F.floor(n / 4).cast("int")
    rows = rows.withColumn(
        "edited", F.concat(F.expr("left(text, char_length(text) - int(floor(char_length(text) / 4)))"),
                           F.when(tail > 0, F.substring("next_text", F.lit(1), tail)).otherwise(""))
    )
    rows = rows.withColumns({"own": tree(F.col("text")), "after": tree(F.col("edited")), "next": tree(F.col("next_text"))})
    return rows.select(
        F.col("id").alias(key),
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        root(F.col("own")).alias("fingerprint"),
        root(F.col("after")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("after")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


_PIECES_SQL = r"regexp_extract_all({0}, '(?s).{{7,63}}?[ e]|.{{1,64}}')"
_PARAGRAPHS_SQL = r"regexp_extract_all({0}, '[^\n]*\n|[^\n]+')"
_ROOT_SQL = rf"""sha256(array_to_string(list_transform(regexp_extract_all({{0}}, '(?s).+?(?:\n{{{{2,}}}}|\z)'),
    lambda s: sha256(array_to_string(list_transform({_PARAGRAPHS_SQL.format("s")}, lambda p:
      sha256(array_to_string(list_transform({_PIECES_SQL.format("p").replace("{", "{{").replace("}", "}}")}, lambda x: md5(x)), ''))), ''))), ''))"""
_LEAVES_SQL = f"""list_distinct(flatten(list_transform({_PARAGRAPHS_SQL},
    lambda p: {_PIECES_SQL.format("p").replace("{", "{{").replace("}", "}}")})))"""
_LIKE_SQL = """CASE WHEN {0} = {2} OR len({1}) + len({3}) = 0 THEN 1.0::DOUBLE
    ELSE 2.0::DOUBLE * len(list_intersect({1}, {3})) / (len({1}) + len({3})) END"""

SQL = f"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id, text) AS i, count(*) OVER () AS n
  FROM documents
), near AS (
  SELECT a.doc_id, a.text, b.text AS next_text,
    a.text[1:length(a.text) - length(a.text) // 4] || b.text[1:length(a.text) // 4] AS edited
  FROM ordered a JOIN ordered b ON b.i = a.i % a.n + 1
), hashed AS (
  SELECT *, {_ROOT_SQL.format("text")} AS r, {_ROOT_SQL.format("edited")} AS er, {_ROOT_SQL.format("next_text")} AS nr,
    {_LEAVES_SQL.format("text")} AS l, {_LEAVES_SQL.format("edited")} AS el, {_LEAVES_SQL.format("next_text")} AS nl
  FROM near
)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, r AS fingerprint,
  er AS edited_fingerprint, {_LIKE_SQL.format("r", "l", "er", "el")} AS near_edited,
  {_LIKE_SQL.format("r", "l", "nr", "nl")} AS near_next
FROM hashed
"""


@check(SQL)
def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
