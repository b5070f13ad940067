"""Sales columns: names at the file edge, names inside the library, and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The column names of the sales file, in file order, with the name used inside.
SALES_COLUMNS = {
    "FECHA": "fecha",
    "CANAL": "canal",
    "SKU": "sku",
    "PRODUCTO": "producto",
    "UNIDADES": "unidades",
    "PORCENTAJE DESCUENTO": "porcentaje_descuento",
    "MONTO APLICADO": "monto_aplicado",
    "BOLETA": "boleta",
    "LOCAL": "local",
    "CODIGO CLIENTE": "codigo_cliente",
    "RUN CLIENTE": "run_cliente",
    "NOMBRES": "nombres",
    "APELLIDOS": "apellidos",
    "FECHA NACIMIENTO": "fecha_nacimiento",
    "GENERO": "genero",
}
PERSONAL_COLUMNS = ("NOMBRES", "APELLIDOS")
GENDER_ALIAS = "GÉNERO"

DERIVED_COLUMNS = {
    "MONTO POR UNIDAD": "monto_por_unidad",
    "EDAD": "edad",
    "FRECUENCIA COMPRA": "frecuencia_compra",
    "ITEMS POR BOLETA": "items_por_boleta",
    "HORA": "hora",
    "DIA SEMANA": "dia_semana",
    "MES": "mes",
    "ANIO": "anio",
    "ES_FIN_DE_SEMANA": "es_fin_de_semana",
}

# Columns coerced to a number, bad text becoming null.
NUMERIC_COLUMNS = ("unidades", "monto_aplicado", "porcentaje_descuento", "local", "sku", "genero")
STRING_COLUMNS = ("canal", "producto", "codigo_cliente", "run_cliente")


def expected_columns() -> list[str]:
    return [c for c in SALES_COLUMNS if c not in PERSONAL_COLUMNS]


def to_internal_names(df: DataFrame) -> DataFrame:
    mapping = {**SALES_COLUMNS, **DERIVED_COLUMNS}
    if GENDER_ALIAS in df.columns and "GENERO" not in df.columns:
        mapping[GENDER_ALIAS] = "genero"
    return df.withColumnsRenamed({c: mapping[c] for c in df.columns if c in mapping})


def to_file_names(df: DataFrame) -> DataFrame:
    mapping = {v: k for k, v in {**SALES_COLUMNS, **DERIVED_COLUMNS}.items()}
    return df.withColumnsRenamed({c: mapping[c] for c in df.columns if c in mapping})


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type, in table order; booleans and dates are not numeric."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
