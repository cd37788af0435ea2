"""Graph documents: a dense matrix of weights, optionally one of distances, and a
dictionary of sensor locations.

A document that is a row of a table is parsed by one task; a file (``read_graph``), or a folder of its
parts, is read row by row of its matrices.  The engine itself works on sparse ``edges(src, dst, weight, distance)`` tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from sensorgrid.functions.once import fields_once
from sensorgrid.staging import reads, stage

ADJACENCY = "adjacency-matrix"
DISTANCE = "distance-matrix"
METADATA = "camera-dictionary"

#: Where a matrix begins, and a later row of it, in pieces as of ``_short``.  A name inside a string ends
#: with a backslash; a row does not begin with a comma.
_OPENS = rf'"({ADJACENCY}|{DISTANCE})"\s*:'
_FIRST = r"\[(?!\s*\])([^\[]*)$"
_ROW = r'^\s*,\s*\[(?!\s*\])([^\[{}"]*)$'
#: So many zeros in a row are one sign, and so many such signs another, if zeros are written in one of these ways.
ZEROS, RUNS = 16, 16
_ZERO = (",0", ", 0", ",0.0", ", 0.0")

_METADATA_DOC = T.StructType(
    [T.StructField(METADATA, T.MapType(T.StringType(), T.StringType()))]
)


def edges_from_documents(docs: DataFrame, check: bool = True) -> DataFrame:
    """``edges`` of a parsed graph document; node ids are matrix positions and zero weights
    are not kept.  With ``check`` set, raises on a missing or non-square matrix, and on more than
    one document, whose positions would mean different nodes (runs a job)."""
    if check and docs.select(F.lit(1)).limit(2).count() > 1:
        raise ValueError("more than one graph document")
    rows = F.coalesce(F.size(F.col(f"`{ADJACENCY}`")), F.lit(0))
    if check:
        square = F.forall(F.col(f"`{ADJACENCY}`"), lambda r: F.size(r) == rows)
        docs = docs.withColumn(
            ADJACENCY,
            F.when(rows <= 0, F.raise_error(F.lit("no adjacency-matrix in graph document")))
            .when(~square, F.raise_error(F.lit("adjacency matrix is not square")))
            .otherwise(F.col(f"`{ADJACENCY}`")),
        )
    # Both matrices are walked side by side, row by row, so no join is needed.
    none = F.array().cast("array<array<double>>")
    rows = docs.select(
        F.posexplode(
            F.arrays_zip(F.col(f"`{ADJACENCY}`").alias("w"), F.coalesce(F.col(f"`{DISTANCE}`"), none).alias("d"))
        ).alias("src", "row")
    )
    cells = rows.select(
        "src",
        F.posexplode(
            F.arrays_zip(F.col("row.w").alias("weight"), F.coalesce(F.col("row.d"), F.array().cast("array<double>")).alias("distance"))
        ).alias("dst", "cell"),
    )
    return cells.where("cell.weight <> 0").select(
        F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"), "cell.weight", "cell.distance"
    )


def _short(piece: Column) -> Column:
    """``piece`` with ``]``, which no piece has, for each ``ZEROS`` cells in a row that are 0, and ``]0`` for
    ``RUNS`` of these: zeros are most of a sparse matrix, so little is left to parse."""
    out = piece
    for zero in reversed(_ZERO):
        run = zero * ZEROS
        # What looks like the last 0 may be where a longer number begins.
        signs = F.regexp_replace(F.replace(piece, F.lit(run), F.lit("]")), r"\](?=[^,\]])", run)
        out = F.when(F.contains(piece, F.lit(run)), F.replace(signs, F.lit("]" * RUNS), F.lit("]0"))).otherwise(out)
    return out


def _lists(row: Column) -> Column:
    """A row as of ``_short`` as lists, of numbers and of signs in turn; a comma that nothing follows stays."""
    return F.concat(F.lit("[["), F.regexp_replace(row, r"\](0?)(?:,(?=\s*[^\s,\]]))?", "],[$1],["), F.lit("]]"))


def _spread(lists: Column) -> Column:
    """The parsed lists of a row, with the zeros that a sign stands for."""
    zeros = [F.array_repeat(F.lit(0.0), F.lit(many)) for many in (ZEROS, ZEROS * RUNS)]
    return F.transform(lists, lambda x, i: F.when(i % 2 == 0, x).when(F.size(x) == 0, zeros[0]).otherwise(zeros[1]))


def _cells(spark: SparkSession, path: str) -> DataFrame:
    """``path, block, id, dst, value, piece`` of the text between closing brackets, with its byte range and
    its order there; a row of a matrix is one piece, so a document is read by as many tasks as its files have ranges.

    There is a row for each cell that is not 0, and after them one for the piece: the matrix it opens, if
    it is blank, its last character (a space, if it is blank) and how many cells it has (NULL if it is no row).
    """
    files = spark.read.option("lineSep", "]").text(path)
    value = files.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), "value",
    )
    place = ["path", "block", "id"]
    pieces = fields_once(value, place, F.struct(_short(F.col("value")).alias("text")))
    # A matrix without rows opens nothing.
    opens = F.rlike("text", F.lit(_OPENS + r"\s*\[\s*\[[^\[]*$"))
    row = F.when(opens & F.rlike("text", F.lit(_FIRST)), F.regexp_extract("text", _FIRST, 1)).when(
        F.rlike("text", F.lit(_ROW)), F.regexp_extract("text", _ROW, 1)
    )
    blank = ~F.rlike("text", F.lit(r"\S"))
    tail = F.when(F.col("text") == "", "").when(blank, " ").otherwise(F.regexp_extract("text", r"(\S)\s*$", 1))
    kinds = F.struct(
        F.when(opens, F.regexp_extract("text", _OPENS, 1)).alias("name"), blank.alias("blank"), tail.alias("tail"),
        _spread(F.from_json(_lists(row), "array<array<double>>")).alias("lists"),
    )
    # One cell more, for the piece.  Joined in a projection, numbers are not boxed.
    end = F.array(F.lit(0.0))
    parsed = fields_once(pieces, place, kinds).withColumn("cells", F.flatten(F.concat("lists", F.array(end))))
    ended = parsed.select(
        *place, "name", "blank", "tail", F.when(F.col("cells").isNotNull(), F.size("cells") - 1).alias("n"),
        F.coalesce("cells", end).alias("cells"),
    )
    last = F.col("dst") == F.coalesce("n", F.lit(0))
    # Without "outer", a filter on the size would join the lists a second time.
    return (
        ended.select(*place, "name", "blank", "tail", "n", F.posexplode_outer("cells").alias("dst", "value"))
        .where((F.col("value") != 0) | F.col("value").isNull() | last)
        .select(*place, "dst", "value", F.when(last, F.struct("name", "blank", "tail", "n")).alias("piece"))
    )


def _outline(cells: DataFrame) -> DataFrame:
    """``path, block, first, before, n, tail``, a row for each byte range in their order: its first id, its number of
    pieces, that of the ranges before it and the last character.  The line break that ends a file
    which others follow is no piece."""
    ranges = cells.where("piece IS NOT NULL").groupBy("path", "block").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), F.max_by("piece.tail", "id").alias("tail")
    )
    # A row for each range, so these windows are small.
    order = Window.orderBy("path", "block")
    follows = F.lead("path").over(order)
    ranges = ranges.withColumn("n", F.col("n") - F.when((follows != F.col("path")) & (F.col("tail") == " "), 1).otherwise(0))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def read_graph(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """``edges`` of the one graph document at ``path``, as of ``edges_from_documents``.

    The document may be as large as a matrix of many thousand nodes and be a single line: it is read once, in
    byte ranges, a matrix row at a time, no task holds more than a row, and only cells that are not 0 are
    kept and joined.  With ``parts`` it is cut into files, in the order of their names, which may be
    compressed; each but the last ends with a line break after a closing bracket.

    Raises on more than one document, a cut off one, a missing or non-square matrix, a matrix given twice
    and a row that is no list of numbers.
    """
    found = _cells(spark, path)
    # What is kept of a range is small as a rule, so a file may hold several.
    files = max(8 * spark.sparkContext.defaultParallelism, found.rdd.getNumPartitions() // 16)
    cells = stage(found.coalesce(files), "graph-cells")
    outline = stage(_outline(cells), "graph-ranges")
    tails = outline.groupBy("path").agg(F.max_by("tail", "block").alias("tail")).orderBy(F.desc("path"))
    last, others = tails.first(), tails.offset(1)
    wrong = others.where(F.lit(not parts) | (F.col("tail") != " ")).limit(1).collect()
    if wrong and (not parts or wrong[0].tail == "}"):
        raise ValueError("more than one graph document")
    if wrong:
        raise ValueError("a part of a graph document does not end with a line break after a bracket")
    if last is not None and last.tail != "}":
        raise ValueError("graph document is cut off")
    ranges = outline.select("path", "block", "first", "before", (F.col("before") + F.col("n")).alias("after"))
    at = F.col("id") - F.col("first") + F.col("before")
    placed = cells.join(ranges, ["path", "block"]).withColumn("at", at).where("at < after")
    pieces = placed.where("piece IS NOT NULL").select("at", "piece.*")
    found = pieces.where("name IS NOT NULL").select("name", "at").limit(3).collect()
    start = {r.name: r["at"] for r in found}
    if len(start) < len(found):
        raise ValueError("a matrix is given twice in graph document")
    if ADJACENCY not in start:
        raise ValueError("no adjacency-matrix in graph document")
    ends = pieces.where("blank").agg(*[F.min(F.when(F.col("at") > at, F.col("at"))).alias(name) for name, at in start.items()]).first()
    if None in ends:
        raise ValueError("graph document is cut off")

    def among(name: str) -> Column:
        return F.col("at").between(start[name], ends[name] - 1)

    def rows(frame: DataFrame, name: str) -> DataFrame:
        return frame.where(among(name)).withColumn("src", F.col("at") - start[name])

    n = ends[ADJACENCY] - start[ADJACENCY]
    faults = [F.min(F.when(among(name) & F.col("n").isNull(), F.col("at") - start[name])).alias(name) for name in start]
    uneven = F.count_if(among(ADJACENCY) & (F.col("n") != n)).alias("uneven")
    checked = pieces.agg(*faults, uneven).first()
    for name in start:
        if checked[name] is not None:
            raise ValueError(f"a row of {name} is no list of numbers: row {checked[name]}")
    if checked["uneven"]:
        raise ValueError("adjacency matrix is not square")
    known = placed.where("piece IS NULL")
    edges = rows(known, ADJACENCY).where("value <> 0").select("src", "dst", F.col("value").alias("weight"))
    if DISTANCE in start:
        # What a row lacks at its end is NULL, as are the rows that are not there.
        lacks = rows(pieces, DISTANCE).where(F.col("n") < n).select(
            "src", F.explode(F.sequence("n", F.lit(n - 1).cast("int"))).alias("dst"), F.lit(None).cast("double").alias("distance")
        )
        far = rows(known, DISTANCE).select("src", "dst", F.col("value").alias("distance"))
        far = far.unionByName(lacks).withColumn("given", F.lit(True))
        zero = F.when(F.col("given").isNull() & (F.col("src") < ends[DISTANCE] - start[DISTANCE]), 0.0)
        edges = edges.join(far, ["src", "dst"], "left").withColumn("distance", F.coalesce("distance", zero))
    else:
        edges = edges.withColumn("distance", F.lit(None).cast("double"))
    return reads(edges.select("src", F.col("dst").cast("bigint").alias("dst"), "weight", "distance"), cells, outline)


def sensor_metadata(docs: DataFrame, value: str = "value") -> DataFrame:
    """``sensor_id, location, name`` from documents ``{dictionary: {id: [[lat, lon], name]}}``.

    Entries that are not lists of at least two items are skipped; a location that is not a
    list becomes NULL.
    """
    parsed = F.from_json(F.col(value), _METADATA_DOC)
    entries = docs.select(F.explode(parsed[METADATA]).alias("id", "info"))
    info = F.from_json(F.col("info"), "array<string>")
    return (
        entries.select("id", F.col("info").alias("raw"), info.alias("info"))
        .where(F.startswith(F.col("raw"), F.lit("[")) & (F.size("info") >= 2))
        .select(
            F.col("id").try_cast("bigint").alias("sensor_id"),
            F.when(
                F.startswith(F.get("info", 0), F.lit("[")),
                F.from_json(F.get("info", 0), "array<double>"),
            ).alias("location"),
            F.get("info", 1).alias("name"),
        )
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.text(path, wholetext=True)
    return sensor_metadata(docs)
