"""Type coercion, row rules with an audit, and imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark import schema
from tillmark.functions.expressions import epoch_days, from_epoch_days
from tillmark.operators.quantiles import counted_median

HAS_ZONE = r"(?:[Zz]|[+-]\d{2}(?::?\d{2})?|\s(?:UTC|GMT|[A-Za-z]+(?:/[A-Za-z_+-]+)+))$"
DECIMAL = r"^\s*[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?\s*$"
#: Text that a cast to a whole number can read; on any other it makes an exception, which costs more than all the rest of a row.
WHOLE = r"^\s*[+-]?\d+\s*$"
#: Other ways to write a day, tried in this order, as a pattern and the ISO text of it: month first, year first, bare digits.
DAY_FORMS = (
    (r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})(?!\d)", "$3-$1-$2"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})(?!\d)", "$1-$2-$3"),
    (r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3"),
)
DAY_FIRST = ((r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})(?!\d)", "$3-$2-$1"), *DAY_FORMS[1:])


def parse_timestamp(df: DataFrame, name: str, day_forms: Sequence[tuple[str, str]] = DAY_FORMS) -> Column:
    """Timestamp without zone, in UTC; text that is no timestamp becomes null.

    Text is read as ISO, a day in one of ``day_forms`` first made ISO. Text with an offset or a zone name
    is an instant and moves to UTC; text without a zone is UTC already.
    """
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        return col
    if isinstance(kind, T.DateType):
        return col.cast("timestamp_ntz")
    if isinstance(kind, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col.cast("timestamp_ntz"))
    return _moment(_iso_text(col, day_forms))


def _iso_text(col: Column, day_forms: Sequence[tuple[str, str]]) -> Column:
    bare = F.trim(col.cast("string"))
    text = bare
    for pattern, iso in reversed(day_forms):
        text = F.when(bare.rlike(pattern), F.regexp_replace(bare, pattern, iso)).otherwise(text)
    return text


def _moment(text: Column) -> Column:
    to_utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.try_to_timestamp(text).cast("timestamp_ntz"))
    return F.when(text.contains(":") & text.rlike(HAS_ZONE), to_utc).otherwise(text.try_cast("timestamp_ntz"))


def _computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``df`` with these columns added, as a generated row: filters on them read their values instead of working them out again."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))) if columns else df


def parse_number(df: DataFrame, name: str) -> Column:
    """Double; text that is no decimal number, and NaN, become null."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        col = F.when(col.rlike(DECIMAL), col)
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def coerce_types(df: DataFrame, day_forms: Sequence[tuple[str, str]] = DAY_FORMS, once: bool = False) -> DataFrame:
    """Internal column names and types; what cannot be read as its type becomes null.

    ``once`` reads all text columns of a row one time, however many filters look at them (they would read the text again).
    It pays if the rows that are left are used whole, and costs a little if only some columns are.
    """
    df = schema.to_internal_names(df)
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    order = df.columns
    dates = [name for name in ("fecha", "fecha_nacimiento") if name in order]
    iso = {name: f"_iso_{name}" for name in dates if once and name in texts}
    df = _computed_once(df, {made: _iso_text(F.col(name), day_forms) for name, made in iso.items()})
    casts = {name: _moment(F.col(iso[name])) if name in iso else parse_timestamp(df, name, day_forms) for name in dates}
    for name in schema.NUMERIC_COLUMNS:
        if name in order:
            casts[name] = parse_number(df, name)
    if "boleta" in order:
        # "123.0" is a receipt number too
        receipt = F.col("boleta")
        receipt = F.when(receipt.rlike(WHOLE), receipt) if "boleta" in texts else receipt
        casts["boleta"] = F.coalesce(receipt.try_cast("bigint"), parse_number(df, "boleta").try_cast("bigint"))
    if once:
        read = {name: f"_read_{name}" for name in casts if name in texts}
        df = _computed_once(df, {made: casts[name] for name, made in read.items()})
        casts |= {name: F.col(made) for name, made in read.items()}
    for name in schema.STRING_COLUMNS:
        if name in order:
            casts[name] = F.col(name).cast("string")
    return df.withColumns(casts).select(*[f"`{name}`" for name in order])


def row_rules(df: DataFrame) -> dict[str, Column]:
    """Condition for keeping a row, per rule, in the order the rules are applied."""
    rules = {
        "required_values": F.col("monto_aplicado").isNotNull() & F.col("unidades").isNotNull() & F.col("fecha").isNotNull(),
        "units_and_amount": (F.col("unidades") > 0) & (F.col("monto_aplicado") >= 0),
    }
    if "boleta" in df.columns:
        rules["receipt_number"] = F.col("boleta") > 0
    if "porcentaje_descuento" in df.columns:
        rules["discount_range"] = F.coalesce("porcentaje_descuento", F.lit(0.0)).between(0.0, 1.0)
    return rules


def keep_valid_rows(df: DataFrame) -> DataFrame:
    for keep in row_rules(df).values():
        df = df.where(keep)
    if "porcentaje_descuento" in df.columns:
        df = df.fillna(0.0, ["porcentaje_descuento"])
    return df


def valid_rows(df: DataFrame, day_forms: Sequence[tuple[str, str]] = DAY_FORMS) -> DataFrame:
    """Coercion, then the row rules."""
    return keep_valid_rows(coerce_types(df, day_forms, once=True))


def cleaning_audit(df: DataFrame) -> DataFrame:
    """Rows removed by each rule (the first that fails), in one pass over coerced rows."""
    rules = row_rules(df)
    failed = F.lit("kept")
    for name, keep in reversed(list(rules.items())):
        failed = F.when(F.coalesce(keep, F.lit(False)), failed).otherwise(name)
    counted = df.select(failed.alias("rule"))
    counts = [
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("rule"), F.count_if(F.col("rule") == name).alias("n_rows"))
        for i, name in enumerate([*rules, "kept"], start=1)
    ]
    return counted.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))


def median_birth(df: DataFrame) -> DataFrame:
    """One row: median birth timestamp of the given rows, from the counts of the different ones."""
    births = df.groupBy("fecha_nacimiento").agg(F.count(F.lit(1)).alias("n"))
    days = births.select(epoch_days(F.col("fecha_nacimiento")).alias("born"), "n")
    return counted_median(days, "born", "n").select(from_epoch_days(F.col("median")).alias("median_birth"))


def modal_value(df: DataFrame, column: str, default: float = 1.0) -> DataFrame:
    """One row: the most frequent non-null value, the smallest on ties, ``default`` if there is none."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.col(column), F.struct(-F.col("n"), F.col(column)))
    return counts.agg(F.coalesce(best, F.lit(default)).alias("mode"))


def impute(df: DataFrame) -> DataFrame:
    """Fill birth dates with their median and gender with its mode, both over all given rows."""
    fills: dict[str, Column] = {}
    if "fecha_nacimiento" in df.columns:
        fills["fecha_nacimiento"] = F.coalesce("fecha_nacimiento", median_birth(df).scalar())
    if "genero" in df.columns:
        fills["genero"] = F.coalesce("genero", modal_value(df, "genero").scalar())
    return df.withColumns(fills)


def clean_sales(df: DataFrame) -> DataFrame:
    """Coercion, row rules, then imputation from the rows that are left."""
    return impute(valid_rows(df))


def imputation_values(valid: DataFrame) -> DataFrame:
    """The two fill values, one row, for rows that passed the rules."""
    born, mode = median_birth(valid), modal_value(valid, "genero")
    return valid.sparkSession.range(1).select(
        born.scalar().alias("median_birth"), mode.scalar().alias("gender_mode")
    )
