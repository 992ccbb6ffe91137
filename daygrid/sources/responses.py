"""Landed daily responses: one CSV text per location, read, judged and normalised for all locations at once.

Every response names its own columns, in its own order. Two readers give the same rows:

* ``split_bodies`` for responses held as one string per row (an attempt log, or small landed files). Header and lines
  sit in the same row, so no shuffle and no join is needed.
* ``split_files`` for landed files too large to hold in one row. Files are read line by line and split over tasks like
  any text; only the per-file header is joined back, and Spark may split a large file's side of that join.

A quoted field may hold line breaks, so a record may span lines. Quotes pair up across lines: a line belongs to the record
before it if an odd number of quotes precedes it. Comment lines are dropped first, wherever they are, and their quotes do
not count; a response whose quotes do not pair up is refused.

Both yield *records*: the location's columns, ``positions`` (where each wanted column is), ``absent`` (wanted columns
the response lacks), ``fields`` (the line's values) and ``problem``. A response with a problem yields exactly one record
and no values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daygrid import fixed_values as fixed
from daygrid.contracts import require_columns
from daygrid.functions.text import csv_fields, has_open_quote, lenient_double, missing_to_null, sql_list, text_array
from daygrid.session import empty_files, new_work_folder

# Largest landed file that is read as one row. Larger files are read line by line.
WHOLE_FILE_BYTES = 32 * 1024 * 1024

NO_CONTENT = "no content"
NO_HEADER = "required headers absent"
LONG_LINE = "a line has more fields than the header"
OPEN_QUOTE = "a line has an unpaired quote"
LONG_RECORD = "a quoted field spans too many lines"
UNKNOWN_COLUMN = "unknown column(s): "

# Columns of a response that are not stored and not complained about.
IGNORED = ("metadata",)

# Lines of one record in a file read by lines: a record is put together in one task, so its length has a bound. Two
# stray quotes far apart in a file would otherwise make most of it one field.
RECORD_LINES = 10_000

# Stands for a line break inside a quoted field while a body is cut into records.
_BREAK = "\x00"

_RECORD = ("positions", "absent", "fields", "problem")


def _lines(body: Column) -> Column:
    return F.split(F.replace(F.replace(body, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), "\n")


def _content_lines(body: Column) -> Column:
    return F.filter(_lines(body), _is_content)


def _is_content(line: Column) -> Column:
    """Blank lines and comment lines are not content."""
    return ~line.rlike(r"^\s*(#|$)")


def _is_comment(line: Column) -> Column:
    return line.rlike(r"^\s*#")


def _records_of(body: Column) -> Column:
    """The content of a body in records: lines, joined by ``_BREAK`` where a quoted field goes on.

    Every second part between quotes is inside a field. Cutting at the quotes takes one pass, whatever the number of lines.
    """
    text = F.array_join(F.filter(_lines(body), lambda line: ~_is_comment(line)), "\n")
    inside = F.transform(
        F.split(text, '"', -1), lambda part, i: F.when(i % 2 == 1, F.replace(part, F.lit("\n"), F.lit(_BREAK))).otherwise(part)
    )
    return F.filter(F.split(F.array_join(inside, '"'), "\n"), _is_content)


def _header_names(header_line: Column) -> Column:
    return F.transform(csv_fields(header_line), lambda name: F.trim(name))


def _header_problem(header_line: Column, required: Sequence[str]) -> Column:
    names = F.transform(F.split(header_line, ","), lambda name: F.trim(name))
    lacking = F.array_except(text_array(required), names)
    return F.when(header_line.isNull(), NO_CONTENT).when(F.size(lacking) > 0, NO_HEADER)


def _unknown_problem(names: Column, wanted: Sequence[str], ignored: Sequence[str]) -> Column:
    """A column the target does not have would be lost without a word, so the response is refused."""
    unknown = F.array_except(names, text_array([*wanted, *ignored]))
    return F.when(F.size(unknown) > 0, F.concat(F.lit(UNKNOWN_COLUMN), F.array_join(unknown, ", ")))


def _layout(names: Column, wanted: Sequence[str]) -> list[Column]:
    """``positions``: zero-based place of each wanted column, -1 where there is none. ``absent``: those without one."""
    columns = text_array(wanted)
    positions = F.transform(columns, lambda name: F.coalesce(F.array_position(names, name), F.lit(0)) - 1)
    return [positions.alias("positions"), F.array_except(columns, names).alias("absent")]


def judge_bodies(
    bodies: DataFrame, body: str = "body", required: Sequence[str] = fixed.REQUIRED_RESPONSE_HEADERS
) -> DataFrame:
    """Add ``header_line`` (first content line) and ``problem`` (NULL when the response may be parsed)."""
    first_line = F.get(_content_lines(F.col(body)), F.lit(0))
    judged = bodies.withColumn("header_line", first_line)
    return judged.withColumn("problem", _header_problem(F.col("header_line"), required))


def split_bodies(
    bodies: DataFrame,
    wanted: Sequence[str],
    body: str = "body",
    required: Sequence[str] = fixed.REQUIRED_RESPONSE_HEADERS,
    ignored: Sequence[str] = IGNORED,
) -> DataFrame:
    """One record per data line of each good response; one valueless record per bad response."""
    keep = [name for name in bodies.columns if name != body]
    content = bodies.select(
        *keep, F.col(body).alias("_body"), _content_lines(F.col(body)).alias("_content"), F.contains(body, F.lit('"')).alias("quoted")
    )
    # Most bodies have no field that spans lines, and their lines are their records.
    spans = F.col("quoted") & F.exists("_content", has_open_quote)
    content = content.withColumn("spans", F.coalesce(spans, F.lit(False)))
    content = content.withColumn("content", F.when(F.col("spans"), _records_of(F.col("_body"))).otherwise(F.col("_content")))
    headed = content.withColumn("header_line", F.get("content", F.lit(0)))
    fields = F.transform(F.slice("content", F.lit(2), F.greatest(F.size("content"), F.lit(1))), csv_fields)
    whole = F.transform(fields, lambda line: F.transform(line, lambda field: F.replace(field, F.lit(_BREAK), F.lit("\n"))))
    parsed = headed.select(
        *keep,
        _header_names(F.replace("header_line", F.lit(_BREAK), F.lit("\n"))).alias("names"),
        _header_problem(F.col("header_line"), required).alias("header_problem"),
        # Quotes pair up within every record but the last.
        (F.col("spans") & has_open_quote(F.get("content", F.size("content") - 1))).alias("open_quote"),
        F.when(F.col("spans"), whole).otherwise(fields).alias("lines"),
    )
    judged = parsed.select(
        *keep,
        *_layout(F.col("names"), wanted),
        F.coalesce(
            F.col("header_problem"),
            _unknown_problem(F.col("names"), wanted, ignored),
            F.when(F.col("open_quote"), OPEN_QUOTE),
            F.when(F.exists("lines", lambda line: F.size(line) > F.size(F.col("names"))), LONG_LINE),
        ).alias("problem"),
        "lines",
    )
    # A bad response keeps its verdict but none of its lines.
    usable = F.when(F.col("problem").isNull(), F.col("lines")).otherwise(F.array(F.lit(None).cast("array<string>")))
    return judged.select(*keep, "positions", "absent", "problem", F.explode(usable).alias("fields"))


def _landed_text(spark: SparkSession, path: str, key: str, whole: bool) -> DataFrame:
    """Landed files under ``path/<key>=<value>/``. The key is read as text, never guessed to be a number."""
    schema = StructType([StructField("value", StringType()), StructField(key, StringType())])
    return spark.read.schema(schema).text(path, wholetext=whole)


def landed_order() -> Column:
    """Orders landed files by arrival: modification time, then path."""
    return F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")).alias("landed")


def split_files(
    spark: SparkSession,
    path: str,
    wanted: Sequence[str],
    key: str = "cell_key",
    required: Sequence[str] = fixed.REQUIRED_RESPONSE_HEADERS,
    ignored: Sequence[str] = IGNORED,
    larger_than: int = -1,
) -> DataFrame:
    """Records of landed files above a size, read line by line.

    A file's header is its first record: the smallest (block start, line number within the task). The header
    table has one row per file and is made with map-side aggregation, so a file holding a third of all lines costs no
    more than its scan. Joining it back is left to the optimizer: it broadcasts only under its own size threshold, and
    otherwise may split the side of a large file over several tasks.

    Whether a field of a file spans lines is known from the same aggregate, which is stored. Only the lines of files that
    have such fields are put in order and joined to records.
    """
    lines = (
        _landed_text(spark, path, key, whole=False)
        .where(F.col("_metadata.file_size") > larger_than)
        .select(
            key,
            landed_order(),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line_no")
            ).alias("place"),
            F.regexp_replace("value", r"\r$", "").alias("line"),
        )
    )
    own = (key, wanted, required, ignored)
    heads = _stored(_heads(lines, *own), "heads")
    simple = _file_records(lines, heads.where(~F.col("open_quote")), key)
    if heads.where("open_quote").limit(1).count() == 0:
        return simple
    spanning = heads.where("open_quote").select("landed")
    kept = _stored(lines.where(~_is_comment(F.col("line"))).join(spanning, "landed", "left_semi"), "lines")
    joined, too_long = spanning_records(kept, [key, "landed"])
    joined = _stored(joined, "records")
    heads = _heads(joined, *own).join(too_long.select("landed", F.lit(LONG_RECORD).alias("long")), "landed", "left")
    heads = heads.withColumn("problem", F.coalesce("long", "problem")).drop("long")
    return simple.unionByName(_file_records(joined, _stored(heads, "heads"), key))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = new_work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _heads(lines: DataFrame, key: str, wanted: Sequence[str], required: Sequence[str], ignored: Sequence[str]) -> DataFrame:
    """One row per file: its header, its layout, its problem, and whether some line of it leaves a quote open."""
    content_place = F.when(_is_content(F.col("line")), F.col("place"))
    return (
        lines.groupBy(key, "landed")
        .agg(
            F.min_by("line", content_place).alias("header_line"),
            F.min(content_place).alias("header_place"),
            F.max(F.when(content_place.isNotNull(), F.size(csv_fields(F.col("line"))))).alias("widest"),
            F.coalesce(F.bool_or(content_place.isNotNull() & has_open_quote(F.col("line"))), F.lit(False)).alias("open_quote"),
        )
        .withColumn("names", _header_names(F.col("header_line")))
        .select(
            key,
            "landed",
            "header_place",
            "open_quote",
            *_layout(F.col("names"), wanted),
            F.coalesce(
                _header_problem(F.col("header_line"), required),
                _unknown_problem(F.col("names"), wanted, ignored),
                F.when(F.col("open_quote"), OPEN_QUOTE),
                F.when(F.col("widest") > F.size("names"), LONG_LINE),
            ).alias("problem"),
        )
    )


def _file_records(lines: DataFrame, heads: DataFrame, key: str) -> DataFrame:
    good_heads = heads.where(F.col("problem").isNull()).drop(key, "open_quote")
    records = (
        lines.where(_is_content(F.col("line")))
        .join(good_heads, "landed")
        .where(F.col("place") != F.col("header_place"))  # a later line that repeats the header is data, and refused
        .select(key, "landed", "positions", "absent", "problem", csv_fields(F.col("line")).alias("fields"))
    )
    bad = heads.where(F.col("problem").isNotNull()).select(
        key, "landed", "positions", "absent", "problem", F.lit(None).cast("array<string>").alias("fields")
    )
    return records.unionByName(bad)


def spanning_records(lines: DataFrame, of: Sequence[str], longest: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Lines (``of``, place, line) joined to records (``of``, place of the first line, line), and ``of`` with a longer one.

    A prefix scan of quote parity in two steps. Each block of a file says how many of its lines leave a quote open; the
    sums over a file's blocks, one row each, tell every block whether it begins inside a field. Then each block is scanned
    by itself. Records are numbered the same way, so one that crosses from block to block keeps its number. Nothing but a
    block, or one record of at most ``longest`` lines, is in one task. A file whose quotes do not pair up ends in a record
    with an open quote.
    """
    of = list(of)
    by_block = Window.partitionBy(*of, "block").orderBy("place")
    flagged = lines.withColumn("block", F.col("place.block")).withColumn("odd", has_open_quote(F.col("line")).cast("long"))
    parity = flagged.groupBy(*of, "block").agg(F.sum("odd").alias("odds"))
    blocks_before = Window.partitionBy(*of).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parity = parity.select(*of, "block", F.coalesce(F.sum("odds").over(blocks_before), F.lit(0)).alias("carried"))
    scanned = flagged.join(parity, [*of, "block"])
    before = F.col("carried") + F.sum("odd").over(by_block) - F.col("odd")
    scanned = scanned.withColumn("starts", (before % 2 == 0).cast("long")).drop("carried")
    starts = scanned.groupBy(*of, "block").agg(F.sum("starts").alias("n"))
    starts = starts.select(*of, "block", F.coalesce(F.sum("n").over(blocks_before), F.lit(0)).alias("carried"))
    numbered = scanned.join(starts, [*of, "block"]).withColumn("record", F.col("carried") + F.sum("starts").over(by_block))

    alone = (F.col("starts") == 1) & (F.col("odd") == 0)
    single = numbered.where(alone).select(*of, "place", "line")
    several = numbered.where(~alone).select(*of, "record", "place", "line")
    sizes = several.groupBy(*of, "record").agg(F.count(F.lit(1)).alias("n"))
    too_long = sizes.where(F.col("n") > (longest or RECORD_LINES)).select(*of).distinct()
    ordered = F.sort_array(F.collect_list(F.struct("place", "line")))
    joined = several.join(too_long, of, "left_anti").groupBy(*of, "record").agg(ordered.alias("parts"))
    text = F.array_join(F.transform("parts", lambda part: part["line"]), "\n")
    joined = joined.select(*of, F.get("parts", F.lit(0))["place"].alias("place"), text.alias("line"))
    return single.unionAll(joined), too_long


def landed_files(spark: SparkSession, path: str, key: str = "cell_key") -> DataFrame:
    """``key, landed, bytes`` of every landed file, empty ones too. Only the listing is read."""
    files = spark.read.format("binaryFile").load(path).select("path", "modificationTime", "length")
    return _landed(files.unionAll(_empty_files(spark, path, key)), key)


def _landed(files: DataFrame, key: str) -> DataFrame:
    name = F.regexp_extract("path", rf"/{key}=([^/]*)/", 1)
    return files.select(
        F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias(key),
        F.struct(F.col("modificationTime").alias("file_modification_time"), F.col("path").alias("file_path")).alias("landed"),
        F.col("length").alias("bytes"),
    )


def _empty_files(spark: SparkSession, path: str, key: str) -> DataFrame:
    found = spark.createDataFrame(empty_files(spark, f"{path.rstrip('/')}/{key}=*/*"), "path string, changed long")
    return found.select("path", F.timestamp_millis("changed").alias("modificationTime"), F.lit(0).cast("long").alias("length"))


def read_landed(
    spark: SparkSession,
    path: str,
    wanted: Sequence[str],
    key: str = "cell_key",
    required: Sequence[str] = fixed.REQUIRED_RESPONSE_HEADERS,
    ignored: Sequence[str] = IGNORED,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """Records of every landed file, with ``landed`` telling which file is newer.

    File size decides the reader; the size test prunes files before any is opened. The text readers return nothing for a
    file without bytes, so those are taken from the listing and refused.
    """
    small = (
        _landed_text(spark, path, key, whole=True)
        .where(F.col("_metadata.file_size") <= whole_file_bytes)
        .select(key, landed_order(), F.col("value").alias("body"))
    )
    empty = _landed(_empty_files(spark, path, key), key).select(key, "landed", F.lit("").alias("body"))
    small = small.unionAll(empty)
    return split_bodies(small, wanted, "body", required, ignored).unionByName(
        split_files(spark, path, wanted, key, required, ignored, larger_than=whole_file_bytes)
    )


def normalise(
    records: DataFrame,
    wanted: Sequence[str],
    renames: Mapping[str, str] = fixed.RESPONSE_RENAMES,
    date_column: str = "date",
    number_columns: Sequence[str] = ("lat", "lon"),
    na_tokens: Sequence[str] = fixed.NA_TOKENS,
) -> DataFrame:
    """Records to observation rows: one text column per wanted field, with date and coordinates typed.

    ``absent`` goes along under the stored names, so that an upsert can leave those columns alone. Undated rows only
    carry spill-over metadata and are dropped. A date that does not parse keeps its row, with the
    reason in ``problem``; use ``accepted`` and ``refused`` to part them.
    """
    require_columns(records, _RECORD, "records")
    keep = [f"`{name}`" for name in records.columns if name not in _RECORD]
    stored = [renames.get(name, name) for name in wanted]
    pairs = sql_list(text for pair in renames.items() for text in pair)
    absent = f"transform(absent, name -> coalesce(element_at(map({pairs}), name), name))" if renames else "absent"
    day = missing_to_null(f"get(fields, get(positions, {stored.index(date_column)}))", na_tokens)
    dated = records.where(f"problem IS NOT NULL OR {day} IS NOT NULL")
    # One array in the wanted order per row; the columns are then plain picks, and generated code stays small however
    # many there are. Most responses lack nothing, and an empty list needs no renaming.
    in_order = f"transform(positions, at -> {missing_to_null('get(fields, at)', na_tokens)}) AS value"
    absent = f"CASE WHEN size(absent) > 0 THEN {absent} ELSE absent END AS absent"
    picks = [f"get(value, {i}) AS `{name}`" for i, name in enumerate(stored)]
    delivered = dated.selectExpr(*keep, "problem", absent, in_order).selectExpr(*keep, "problem", "absent", *picks)
    typed = {name: lenient_double(F.col(name)) for name in number_columns if name in stored}
    typed[date_column] = F.try_to_date(F.col(date_column), "yyyy-MM-dd")
    unreadable = [
        F.when(F.col(name).isNotNull() & value.isNull(), f"unreadable {name}") for name, value in typed.items()
    ]
    return delivered.withColumns({"problem": F.coalesce("problem", *unreadable), **typed})


def accepted(observations: DataFrame) -> DataFrame:
    return observations.where(F.col("problem").isNull()).drop("problem")


def refused(observations: DataFrame) -> DataFrame:
    return observations.where(F.col("problem").isNotNull())
