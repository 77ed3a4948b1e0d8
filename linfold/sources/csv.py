"""CSV source and sink (the source job ingested one headered, comma-delimited file)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linfold.functions.exprs import lit_str, q


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True,
             delimiter: str = ",", infer_schema: bool = False, **options) -> DataFrame:
    """Read CSV from any Hadoop path. Pass ``schema`` on large inputs: inference reads
    the data once more before the real scan."""
    reader = spark.read.option("header", str(header).lower()).option("delimiter", delimiter)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True, delimiter: str = ",", mode: str = "overwrite") -> str:
    """Write one CSV part per partition (parallel, no funnel through one task)."""
    df.write.mode(mode).option("header", str(header).lower()).option("delimiter", delimiter).csv(path)
    return path


#: What casts strip at both ends of a text, besides the spaces that ``trim`` takes.
_PAD = r"[\x00-\x20\x7F]*"
_MONTH_DAY = "((0[13578]|1[02])-(0[1-9]|[12][0-9]|3[01])|(0[469]|11)-(0[1-9]|[12][0-9]|30)|02-(0[1-9]|[12][0-9]))"
_CLOCK = (r"([01]?[0-9]|2[0-3])(:[0-5]?[0-9](:[0-5]?[0-9](\.[0-9]*)?"
          rf"({_PAD}[A-Za-z+-][A-Za-z0-9~/._:+-]*)?)?)?")
#: Types from narrow to wide, each with the shape that a text must have (None: any) and the test that it must pass
#: (``{v}``: the trimmed text). A try_cast of a text that is no such value throws and catches inside, which costs far more
#: than all else in reading a line; so the shape turns these away first, and the cast decides on what is left.
_DIGITS = "try_cast(regexp_substr({v}, '[+-]?[0-9]+') AS DECIMAL(38, 0))"
LATTICE = (
    ("int", rf"^{_PAD}[+-]?0*[0-9]{{1,10}}{_PAD}\z",
     "shiftright(try_cast({v} AS BIGINT), 31) IN (0, -1)"),
    ("bigint", rf"^{_PAD}[+-]?0*[0-9]{{1,19}}{_PAD}\z",
     f"(length({{v}}) < 19 OR ({_DIGITS} >= -9223372036854775808 AND {_DIGITS} <= 9223372036854775807))"),
    ("double", rf"(?i)^{_PAD}[+-]?(nan|inf|infinity|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?[fd]?"
               rf"|0x([0-9a-f]+\.?[0-9a-f]*|\.[0-9a-f]+)p[+-]?[0-9]+[fd]?){_PAD}\z", "try_cast({v} AS DOUBLE) IS NOT NULL"),
    ("boolean", None, "lower({v}) IN ('true', 'false')"),
    ("date", f"^[0-9]{{4}}-{_MONTH_DAY}$", "try_cast({v} AS DATE) IS NOT NULL"),
    ("timestamp", rf"^[0-9]{{4}}-(0?[1-9]|1[0-2])(-(0?[1-9]|[12][0-9]|3[01])([ T]{_CLOCK})?)?{_PAD}\z",
     "try_cast({v} AS TIMESTAMP) IS NOT NULL"))
#: Texts in the plainest form of a type: a condition that costs less than a shape, the shape, and all types that such a text
#: is of. Every other text (a sign +, an exponent, the 29th of February, ...) goes through all tests of the lattice.
_PLAIN_DAY = _MONTH_DAY.replace("02-(0[1-9]|[12][0-9])", "02-(0[1-9]|1[0-9]|2[0-8])")
PLAIN = (
    ("octet_length({v}) < 10 AND NOT contains({v}, '.')", r"^-?[0-9]+\z", ("int", "bigint", "double")),
    ("contains({v}, '.')", r"^-?[0-9]+\.[0-9]+\z", ("double",)),
    ("octet_length({v}) = 10", rf"^[0-9]{{4}}-{_PLAIN_DAY}\z", ("date", "timestamp")),
    ("octet_length({v}) = 19", rf"^[0-9]{{4}}-{_PLAIN_DAY} ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z", ("timestamp",)))
#: Lines that may rule a type out before all lines are tested for the types that are left.
FIRST_LINES = 100
_BAD = "_malformed"


def _text_columns(spark: SparkSession, path: str, names, header: bool, delimiter: str, options: dict) -> DataFrame:
    """Every field as text, and the line itself where it has not as many fields as there are columns."""
    schema = ", ".join(f"{q(c)} string" for c in names) + f", {_BAD} string"
    return read_csv(spark, path, schema, header, delimiter, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD,
                    columnPruning="false", enforceSchema="true", **options)


def type_test(value: str, shape: str | None, test: str) -> str:
    """SQL: whether a text is of a type of the lattice. A NULL is of no type with a shape, and has no say on one without.

    CASE and not AND: Spark computes what an AND has twice (or a BETWEEN once) before its first operand is known.
    """
    checked = test.format(v=value)
    return checked if shape is None else f"CASE WHEN {value} RLIKE {lit_str(shape)} THEN {checked} ELSE false END"


def types_of(value: str, kinds) -> str:
    """SQL: the types of a text among ``kinds`` as one number, a bit for each type of the lattice (a NULL: see `type_test`)."""
    bit = {kind: 1 << j for j, (kind, *_) in enumerate(LATTICE)}
    tested = " | ".join(f"CASE WHEN coalesce({type_test(value, shape, test)}, true) THEN {bit[kind]} ELSE 0 END"
                        for kind, shape, test in LATTICE if kind in kinds)
    plain = " ".join(f"WHEN {cheap.format(v=value)} AND {value} RLIKE {lit_str(shape)} THEN {sum(bit[k] for k in of if k in kinds)}"
                     for cheap, shape, of in PLAIN if not kinds.isdisjoint(of))
    return f"CASE {plain} ELSE {tested} END" if plain else tested


def _types_of_all(cells: DataFrame, left: dict[str, set[str]]) -> dict[str, tuple[set[str], bool]]:
    """For each column, which of the types that are left for it all its values are of, and whether it has a value: a state
    that merges, so each task sends one row a column.

    Columns become rows first, so that the code of the tests does not grow with the number of columns.
    """
    if not left:
        return {}
    tested = cells.unpivot([], [F.col(f"`{i}`") for i in left], "i", "v").selectExpr(
        "i", "v IS NOT NULL AS has", f"{types_of('v', set().union(*left.values()))} AS types")
    found = tested.groupBy("i").agg(F.bit_and("types").alias("types"), F.bool_or("has").alias("has")).collect()
    return {r["i"]: ({kind for j, (kind, *_) in enumerate(LATTICE) if r["types"] >> j & 1} & left[r["i"]], r["has"]) for r in found}


def infer_types(texts: DataFrame, names) -> dict[str, str]:
    """The narrowest type that all values of a text column are of; text, where there is none.

    A value that is not of a type rules it out for the column, whatever the others are. So a few lines come first, and
    all lines are tested for the types left by these. The first lines only rule types out: a type that is
    returned has passed on every line, and the result does not depend on which lines come first.
    """
    cells = texts.where(f"{_BAD} IS NULL").selectExpr(*[f"trim({q(c)}) AS `{i}`" for i, c in enumerate(names)])
    every = {str(i): {kind for kind, *_ in LATTICE} for i in range(len(names))}
    left = {i: kinds for i, (kinds, _) in _types_of_all(cells.limit(FIRST_LINES), every).items() if kinds}
    passed = {i: kinds for i, (kinds, has) in _types_of_all(cells, left).items() if has}
    return {c: next((kind for kind, *_ in LATTICE if kind in passed.get(str(i), ())), "string") for i, c in enumerate(names)}


def read_csv_inferred(spark: SparkSession, path: str, names=None, header: bool = True, delimiter: str = ",",
                      **options) -> tuple[DataFrame, DataFrame]:
    """(typed rows, malformed lines): CSV from any Hadoop path with types inferred from all its rows.

    Lines with too few or too many fields take no part in the types and are set aside as (``line``), so that rows
    and malformed lines together are all lines. Without ``names`` the header of the first file names the columns.
    Empty fields are NULL.
    """
    if names is None:
        if not header:
            raise ValueError("without a header the columns need names")
        names = read_csv(spark, path, header=True, delimiter=delimiter, **options).columns
    if _BAD in names:
        raise ValueError(f"a column cannot be called {_BAD}")
    texts = _text_columns(spark, path, names, header, delimiter, options)
    types = infer_types(texts, names)
    # Spark reads malformed lines only along with another column, whatever the caller selects later.
    too = f"length(coalesce({q(names[0])}, '')) >= 0"
    good = texts.where(f"{_BAD} IS NULL AND {too}").selectExpr(*[
        q(c) if types[c] == "string" else f"CAST(trim({q(c)}) AS {types[c]}) AS {q(c)}" for c in names])
    return good, texts.where(f"{_BAD} IS NOT NULL AND {too}").selectExpr(f"{_BAD} AS line")
