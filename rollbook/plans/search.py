"""Searches over the loaded registry tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.match import like_any, same_text
from rollbook.operators.relate import join_list, join_selected

# The search the registry is queried with, and its report columns.
BUILDING_WORDS = ("Condomínio", "Edificio", "Residencial")
CITY = "OSASCO"
REPORT_COLUMNS = (
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "razao_social", "nome_fantasia", "porte_empresa",
    "situacao_cadastral", "tipo_logradouro", "logradouro", "numero", "complemento", "bairro",
    "cep", "uf", "municipio", "ddd_1", "telefone_1", "ddd_2", "telefone_2",
    "correio_eletronico", "situacao_especial",
)


def _matching(branches: DataFrame, companies: DataFrame, cities: DataFrame,
              words: Iterable[str], city: str, ci_ai: bool) -> DataFrame:
    """Both filters and the city list come before the one shuffled join, so only
    matching branches move, and of large company tables only companies that may have one."""
    wanted = cities.filter(same_text(F.col("nome"), city, ci_ai)).select(
        F.col("codigo").alias("__city"), F.col("nome").alias("nome_municipio")
    )
    found = branches.filter(like_any(F.col("nome_fantasia"), words, ci_ai))
    found = join_list(found, wanted, F.col("municipio") == F.col("__city"), "inner").drop("__city")
    return join_selected(found, companies, "cnpj_basico")


def branch_search(branches: DataFrame, companies: DataFrame, cities: DataFrame,
                  words: Iterable[str] = BUILDING_WORDS, city: str = CITY,
                  ci_ai: bool = False) -> DataFrame:
    """The company key of every matching branch, once per branch."""
    return _matching(
        branches, companies.select("cnpj_basico"), cities, words, city, ci_ai
    ).select("cnpj_basico")


def branch_report(branches: DataFrame, companies: DataFrame, cities: DataFrame,
                  words: Iterable[str] = BUILDING_WORDS, city: str = CITY,
                  postcode: str | None = None, ci_ai: bool = False) -> DataFrame:
    """Address and contact columns of matching branches, by part of the postcode too."""
    if postcode:
        branches = branches.filter(F.col("cep").contains(postcode))
    own = [c for c in ("razao_social", "porte_empresa") if c in companies.columns]
    found = _matching(
        branches, companies.select("cnpj_basico", *own), cities, words, city, ci_ai
    )
    return found.select(*REPORT_COLUMNS, "nome_municipio")
