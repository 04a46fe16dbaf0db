"""Ingest described by a JSON manifest: relation name, schema, source, delimiter."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from iterweave.sinks import store
from iterweave.sources.text import read_delimited

# The type names a manifest may use.
COLUMN_TYPES = {
    "LONG_TYPE": T.LongType(),
    "DOUBLE_TYPE": T.DoubleType(),
    "FLOAT_TYPE": T.FloatType(),
    "STRING_TYPE": T.StringType(),
}


@dataclass(frozen=True)
class Manifest:
    name: str
    schema: T.StructType
    uri: str
    delimiter: str

    @property
    def relation(self) -> str:
        """The key as one name of the catalog."""
        return self.name.replace(".", "_")

    @staticmethod
    def parse(document: str | dict) -> Manifest:
        doc = json.loads(document) if isinstance(document, str) else document
        types, names = doc["schema"]["columnTypes"], doc["schema"]["columnNames"]
        if len(types) != len(names):
            raise ValueError(f"{len(types)} column types for {len(names)} column names")
        unknown = sorted(set(types) - set(COLUMN_TYPES))
        if unknown:
            raise ValueError(f"unknown column types: {', '.join(unknown)}")
        source = doc["source"]
        uri = {"URI": source.get("uri"), "File": source.get("filename")}.get(source["dataType"])
        if not uri:
            raise ValueError(f"no location in source {source}")
        fields = [T.StructField(n, COLUMN_TYPES[t]) for n, t in zip(names, types)]
        key = doc["relationKey"]
        return Manifest(
            name=".".join((key["userName"], key["programName"], key["relationName"])),
            schema=T.StructType(fields),
            uri=uri,
            delimiter=doc.get("delimiter", ","),
        )


def ingest(spark: SparkSession, document: str | dict) -> DataFrame:
    """Store the relation a manifest describes under its key, and scan it."""
    m = Manifest.parse(document)
    return store(read_delimited(spark, m.uri, m.schema, delimiter=m.delimiter), m.relation)
