"""Text files and text columns as tables of lines, batches, chunks and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.functions import symbols as S
from corpusweave.functions.patterns import END_OF_TEXT
from corpusweave.functions.ordered import row_index


def drop_invalid(text: Column) -> Column:
    """Remove invalid UTF-8; a genuine U+FFFD of a valid text stays."""
    return F.when(F.is_valid_utf8(text), text).otherwise(
        F.replace(F.make_valid_utf8(text), F.lit("�"), F.lit(""))
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files, invalid bytes dropped. Large files are read in splits."""
    return spark.read.text(path).select(drop_invalid(F.col("value")).alias("text"))


def read_whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, for collections of files that are each one document."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("path"), drop_invalid(F.col("value")).alias("text")
    )


def read_records(spark: SparkSession, path: str, token: str = END_OF_TEXT) -> DataFrame:
    """Records of text files separated by a token; splits end at the token, never inside a record."""
    lines = spark.read.option("lineSep", token).text(path)
    return lines.select(drop_invalid(F.col("value")).alias("text"))


def line_array(text: Column) -> Column:
    """Lines with their line ends; a final line end does not start another line."""
    return F.regexp_extract_all(text, F.lit(r"[^\n]*\n|[^\n]+"), F.lit(0))


def first_lines(docs: DataFrame, n_lines: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The first lines of every text as (key, line_no, line), line ends kept."""
    kept = F.slice(line_array(F.col(text)), 1, n_lines)
    return docs.select(key, F.posexplode(kept).alias("line_no", "line"))


def line_batches(
    docs: DataFrame,
    batch_size: int = 4096,
    n_lines: int | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Consecutive lines joined until they hold at least ``batch_size`` characters.

    The last batch may be smaller. Rows are (key, batch_no, batch).
    """
    lines = line_array(F.col(text))
    if n_lines is not None:
        lines = F.slice(lines, 1, n_lines)
    empty = F.struct(
        F.array().cast("array<string>").alias("done"), F.lit("").alias("open")
    )

    def add(state, line):
        grown = F.concat(state["open"], line)
        full = F.length(grown) >= batch_size
        return F.struct(
            F.when(full, F.concat(state["done"], F.array(grown))).otherwise(state["done"]).alias("done"),
            F.when(full, F.lit("")).otherwise(grown).alias("open"),
        )

    def finish(state):
        return F.when(state["open"] == "", state["done"]).otherwise(
            F.concat(state["done"], F.array(state["open"]))
        )

    batches = F.aggregate(lines, empty, add, finish)
    return docs.select(key, F.posexplode(batches).alias("batch_no", "batch"))


def byte_chunks(docs: DataFrame, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks of ``size`` bytes; a character that crosses a border goes to the later chunk."""
    raw = docs.select(key, F.encode(F.col(text), "UTF-8").alias("_b")).withColumn(
        "_n", F.octet_length("_b")
    )
    placed = raw.filter("_n > 0").select(
        key, "_b", "_n", F.explode(F.sequence(F.lit(0), F.expr(f"int((_n - 1) div {size})"))).alias("chunk_no")
    )

    def continues(at: Column) -> Column:
        # Continuation bytes are 10xxxxxx.
        return F.hex(F.substring("_b", at + 1, 1)).rlike("^[89AB]")

    def border(at: Column) -> Column:
        """The lead byte of the character that holds byte ``at``."""
        stepped = (
            F.when(~continues(at), at)
            .when(~continues(at - 1), at - 1)
            .when(~continues(at - 2), at - 2)
            .otherwise(at - 3)
        )
        return F.when(at >= F.col("_n"), F.col("_n")).otherwise(stepped)

    begin, end = border(F.col("chunk_no") * size), border((F.col("chunk_no") + 1) * size)
    chunk = F.substring(F.col("_b"), begin + 1, end - begin)
    return placed.select(key, "chunk_no", S.bytes_to_text(chunk).alias("chunk"))


def split_records(
    docs: DataFrame, token: str = END_OF_TEXT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every text cut before each occurrence of the token, so a record starts at its token."""
    parts = F.filter(
        F.split(F.col(text), r"(?=\Q" + token + r"\E)"), lambda p: p != ""
    )
    return docs.select(key, F.posexplode(parts).alias("record_no", "record"))


def split_even(
    docs: DataFrame,
    chunks: int,
    token: str = END_OF_TEXT,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """About ``chunks`` parts of equal bytes whose borders are moved on to the next token.

    Borders that fall together give fewer parts.
    """
    data = S.text_to_symbols(F.col(text))
    mark = token.encode("utf-8").decode("latin-1")
    raw = docs.select(key, data.alias("_s")).withColumn("_n", F.length("_s")).filter("_n > 0")
    guesses = [F.expr(f"{i} * (_n div {chunks})") for i in range(1, chunks)]
    borders = [
        F.coalesce(
            F.nullif(F.position(F.lit(mark), F.col("_s"), g + 1), F.lit(0)) - 1, F.col("_n")
        )
        for g in guesses
    ]
    ends = F.array_sort(F.array_distinct(F.array(F.lit(0), *borders, F.col("_n"))))
    placed = raw.select(key, "_s", ends.alias("_e")).select(
        key, "_s", "_e", F.posexplode(F.slice("_e", F.lit(1), F.size("_e") - 1)).alias("part_no", "_from")
    )
    piece = F.substring(F.col("_s"), F.col("_from") + 1, F.get("_e", F.col("part_no") + 1) - F.col("_from"))
    return placed.select(
        key, "part_no", S.bytes_to_text(F.encode(piece, "ISO-8859-1")).alias("part")
    )


# --- Parquet tables (S6-S11) --------------------------------------------------------------------


def schema_table(df: DataFrame) -> DataFrame:
    """Schema as rows (position, name, type, nullable)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Parquet with only the named columns read from disk."""
    return spark.read.parquet(path).select(*columns)


def row_batches(df: DataFrame, order: list[str], size: int = 1000) -> DataFrame:
    """Deterministic ``batch_id`` of ``size`` consecutive rows in ``order``."""
    placed = row_index(df, order, "_at")
    return placed.withColumn("batch_id", F.expr(f"_at div {size}")).drop("_at")


def first_values(
    df: DataFrame, column: str, order: list[str], n_rows: int | None = None, size: int = 1000
) -> DataFrame:
    """One column in order, cut to its first ``n_rows`` values, with batch numbers."""
    chosen = df.select(*order, column)
    if n_rows is not None:
        chosen = chosen.orderBy(*order).limit(n_rows)
    return row_batches(chosen, order, size)


def _joined(groups: DataFrame, by: list[str], column: str, order: list[str]) -> DataFrame:
    kept = groups.filter(F.col(column).isNotNull() & (F.col(column) != ""))
    parts = F.array_sort(F.collect_list(F.struct(*order, F.col(column).alias("_v"))))
    return kept.groupBy(*by).agg(
        F.array_join(F.transform(parts, lambda p: p["_v"]), "\n").alias("text"),
        F.count(F.lit(1)).alias("n_values"),
    )


def joined_batches(df: DataFrame, column: str, order: list[str], size: int = 1000) -> DataFrame:
    """Non-empty values of every batch joined by line ends; a batch holds at most ``size`` rows."""
    return _joined(row_batches(df.select(*order, column), order, size), ["batch_id"], column, order)


def first_text(df: DataFrame, column: str, order: list[str], n_rows: int = 1000) -> DataFrame:
    """The first ``n_rows`` values joined; the limit counts rows before empty ones are left out."""
    head = df.select(*order, column).orderBy(*order).limit(n_rows).withColumn("_one", F.lit(0))
    return _joined(head, ["_one"], column, order).drop("_one")
