"""Literal relations."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

CODES_DDL = "dominio string, codigo string, descricao string"

# Operation codes and their official descriptions.
OPERATION_CODES = [
    ("codigo_di", "0", "Etapa Regular"),
    ("codigo_di", "2", "Etapa Extra"),
    ("codigo_di", "3", "Etapa de Retorno"),
    ("codigo_di", "4", "Inclusão de Etapa"),
    ("codigo_di", "6", "Etapa Não Remunerada Sem Transporte de Objetos"),
    ("codigo_di", "7", "Etapa de Voo de Fretamento"),
    ("codigo_di", "9", "Etapa de Voo Charter"),
    ("codigo_di", "D", "Etapa de Voo Duplicada"),
    ("codigo_di", "E", "Etapa Não Remunerada Com Transporte de Objetos"),
    ("codigo_tipo_linha", "N", "Doméstica Mista"),
    ("codigo_tipo_linha", "C", "Doméstica Cargueira"),
    ("codigo_tipo_linha", "I", "Internacional Mista"),
    ("codigo_tipo_linha", "G", "Internacional Cargueira"),
]


def seed_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A literal list as a local relation: Catalyst knows its exact size and folds filters into it."""
    schema = StructType.fromDDL(ddl)
    columns = zip(*rows) if rows else [()] * len(schema)
    arrow = pa.table(
        [pa.array(list(values), type=to_arrow_type(field.dataType)) for field, values in zip(schema, columns)],
        names=schema.names,
    )
    return spark.createDataFrame(arrow, schema)


def operation_codes(spark: SparkSession) -> DataFrame:
    return seed_table(spark, OPERATION_CODES, CODES_DDL)
