"""Declared tables: column kinds, text limits, keys, file patterns and links.

A table is data, not code: the scan, the typed projection, the reject reasons
and the table DDL are all derived from its list of fields.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT = "text"  # cleaned text with a length limit
INTEGER = "integer"  # digits and minus sign kept, then int
ASSIGNED = "assigned"  # cleaned text that the store casts to int
CODE = "code"  # int-cleaned, but stored as text (leading zeros vanish)
MONEY = "money"  # 1.234,56 -> decimal(15,2)
DATE = "date"  # yyyyMMdd

SPARK_TYPES = {
    TEXT: T.StringType(),
    INTEGER: T.IntegerType(),
    ASSIGNED: T.IntegerType(),
    CODE: T.StringType(),
    MONEY: T.DecimalType(15, 2),
    DATE: T.DateType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = TEXT
    limit: int | None = None

    @property
    def data_type(self) -> T.DataType:
        return SPARK_TYPES[self.kind]


@dataclass(frozen=True)
class Link:
    """Many-to-one reference from ``child.column`` to ``parent.key``; of each code in the
    column's text if that is ``listed``, with commas."""

    child: str
    column: str
    parent: str
    key: str
    listed: bool = False


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    pattern: str | None = None  # substring of the upper-cased file name
    primary_key: str | None = None
    join_key: str | None = None

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def raw_schema(self) -> T.StructType:
        """What the scan reads: every cell is text, named by position."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.data_type) for f in self.fields])


def text(name: str, limit: int = 255) -> Field:
    return Field(name, TEXT, limit)


def integer(name: str) -> Field:
    return Field(name, INTEGER)


def assigned(name: str) -> Field:
    return Field(name, ASSIGNED)


def code(name: str, limit: int = 255) -> Field:
    return Field(name, CODE, limit)


def money(name: str) -> Field:
    return Field(name, MONEY)


def date(name: str) -> Field:
    return Field(name, DATE)


def code_list(name: str, pattern: str) -> Table:
    return Table(name, (integer("codigo"), text("nome")), pattern, primary_key="codigo")


# ---------------------------------------------------------------------------
# The published layout of the registry files.
# ---------------------------------------------------------------------------

EMPRESA = Table(
    "empresa",
    (
        text("cnpj_basico", 14),
        text("razao_social"),
        integer("natureza_juridica"),
        integer("qualificacao_responsavel"),
        money("capital_social"),
        integer("porte_empresa"),
        text("ente_federativo_responsavel"),
    ),
    pattern="EMPRE",
    join_key="cnpj_basico",
)

ESTABELECIMENTO = Table(
    "estabelecimento",
    (
        text("cnpj_basico", 14),
        text("cnpj_ordem", 4),
        text("cnpj_dv", 2),
        integer("identificador_matriz_filial"),
        text("nome_fantasia"),
        integer("situacao_cadastral"),
        date("data_situacao_cadastral"),
        code("motivo_situacao_cadastral"),
        text("nome_cidade_exterior"),
        code("pais"),
        date("data_inicio_atividade"),
        assigned("cnae_fiscal_principal"),
        text("cnae_fiscal_secundaria", 1000),
        text("tipo_logradouro"),
        text("logradouro"),
        text("numero", 10),
        text("complemento"),
        text("bairro"),
        text("cep", 8),
        text("uf", 2),
        integer("municipio"),
        text("ddd_1", 4),
        text("telefone_1", 20),
        text("ddd_2", 4),
        text("telefone_2", 20),
        text("dd_fax", 4),
        text("fax", 20),
        text("correio_eletronico"),
        text("situacao_especial"),
        date("data_situacao_especial"),
    ),
    pattern="ESTABELE",
    join_key="cnpj_basico",
)

SOCIOS = Table(
    "socios",
    (
        text("cnpj_basico", 14),
        assigned("identificador_socio"),
        text("nome_socio_razao_social"),
        text("cpf_cnpj_socio", 14),
        assigned("qualificacao_socio"),
        date("data_entrada_sociedade"),
        integer("pais"),
        text("representante_legal"),
        text("nome_do_representante"),
        assigned("qualificacao_representante_legal"),
        integer("faixa_etaria"),
    ),
    pattern="SOCIO",
    join_key="cnpj_basico",
)

SIMPLES = Table(
    "simples",
    (
        text("cnpj_basico", 14),
        text("opcao_simples", 1),
        date("data_opcao_simples"),
        date("data_exclusao_simples"),
        text("opcao_mei", 3),
        date("data_opcao_mei"),
        date("data_exclusao_mei"),
    ),
    pattern="SIMPLES",
    join_key="cnpj_basico",
)

# In routing order: the first table whose pattern is in the file name wins.
REGISTRY: dict[str, Table] = {
    t.name: t
    for t in (
        EMPRESA,
        ESTABELECIMENTO,
        SOCIOS,
        SIMPLES,
        code_list("cnae", "CNAE"),
        code_list("moti", "MOTI"),
        code_list("munic", "MUNIC"),
        code_list("natju", "NATJU"),
        code_list("pais", "PAIS"),
        code_list("quals", "QUALS"),
    )
}

# Code lists are loaded before the tables that refer to them.
LOAD_ORDER = (
    "pais", "munic", "quals", "natju", "cnae", "moti",
    "empresa", "estabelecimento", "socios", "simples",
)

# Many side -> one side.
LINKS = (
    Link("empresa", "natureza_juridica", "natju", "codigo"),
    Link("estabelecimento", "cnae_fiscal_principal", "cnae", "codigo"),
    Link("estabelecimento", "cnae_fiscal_secundaria", "cnae", "codigo", listed=True),
    Link("estabelecimento", "pais", "pais", "codigo"),
    Link("socios", "pais", "pais", "codigo"),
    Link("estabelecimento", "municipio", "munic", "codigo"),
    Link("empresa", "qualificacao_responsavel", "quals", "codigo"),
    Link("socios", "qualificacao_socio", "quals", "codigo"),
    Link("socios", "qualificacao_representante_legal", "quals", "codigo"),
    Link("estabelecimento", "motivo_situacao_cadastral", "moti", "codigo"),
    Link("simples", "cnpj_basico", "empresa", "cnpj_basico"),
    Link("estabelecimento", "cnpj_basico", "empresa", "cnpj_basico"),
    Link("socios", "cnpj_basico", "empresa", "cnpj_basico"),
    Link("socios", "cnpj_basico", "estabelecimento", "cnpj_basico"),
)

# Columns of the registry that lookups go by, table by table.
LOOKUP_COLUMNS = {
    "estabelecimento": ("uf", "municipio", "cnae_fiscal_principal"),
    "empresa": ("natureza_juridica",),
    "socios": ("cpf_cnpj_socio",),
}

# Texts that searches look into.
SEARCH_COLUMNS = {
    "estabelecimento": ("nome_fantasia",),
    "empresa": ("razao_social",),
}
