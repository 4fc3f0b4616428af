"""Code → label decoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The register's codes and the published labels.
PARTNER_TYPE = {
    "1": "PESSOA JURÍDICA",
    "2": "PESSOA FÍSICA",
    "3": "ESTRANGEIRO",
}
AGE_BAND = {
    "0": "Não se aplica",
    "1": "Entre 0 a 12 anos",
    "2": "Entre 13 a 20 anos",
    "3": "Entre 21 a 30 anos",
    "4": "Entre 31 a 40 anos",
    "5": "Entre 41 a 50 anos",
    "6": "Entre 51 a 60 anos",
    "7": "Entre 61 a 70 anos",
    "8": "Entre 71 a 80 anos",
    "9": "Maiores de 80 anos",
}
BRANCH = {
    "1": "Matriz",
    "2": "Filial",
}
STATUS = {
    "01": "Nula",
    "02": "Ativa",
    "03": "Suspensa",
    "04": "Inapta",
    "08": "Baixada",
}
SIZE = {
    "01": "NAO INFORMADO",
    "02": "MICRO EMPRESA",
    "03": "EMPRESA DE PEQUENO PORTE",
    "05": "DEMAIS",
}


def decode(code: Column, labels: Mapping[str, str], default: str | None = None) -> Column:
    """Label of ``code``; ``default`` for NULL and for codes without a label."""
    label = F
    for value, text in labels.items():
        label = label.when(code == value, F.lit(text))
    return label.otherwise(F.lit(default).cast("string"))


def partner_type(code: Column) -> Column:
    return decode(code, PARTNER_TYPE)


def age_band(code: Column) -> Column:
    return decode(code, AGE_BAND)


def branch(code: Column) -> Column:
    """Head office or branch. Anything else, NULL included, becomes the empty string."""
    return decode(code, BRANCH, default="")


def status(code: Column) -> Column:
    return decode(code, STATUS)


def size(code: Column) -> Column:
    return decode(code, SIZE)
