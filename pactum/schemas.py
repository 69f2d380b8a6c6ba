"""Explicit schemas of the JSON documents read from outside."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


CONTRACT_LINK = StructType(
    [
        *strings("processo_id", "url", "company_name", "company_cnpj", "contract_value"),
        StructField("discovery_path", ArrayType(StringType())),
        *strings("discovered_at"),
    ]
)
DISCOVERY = StructType([*strings("discovery_date"), StructField("processos", ArrayType(CONTRACT_LINK))])
