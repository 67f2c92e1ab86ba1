"""Names of the federal states."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# State codes and the names reported for them.
STATE_NAMES = {
    "AC": "ACRE",
    "AL": "ALAGOAS",
    "AM": "AMAZONAS",
    "AP": "AMAPA",
    "BA": "BAHIA",
    "CE": "CEARA",
    "DF": "DISTRITO FEDERAL",
    "ES": "ESPIRITO SANTO",
    "GO": "GOIAS",
    "MA": "MARANHAO",
    "MG": "MINAS GERAIS",
    "MS": "MATO GROSSO DO SUL",
    "MT": "MATO GROSSO",
    "PA": "PARA",
    "PB": "PARAIBA",
    "PE": "PERNAMBUCO",
    "PI": "PIAUI",
    "PR": "PARANA",
    "RJ": "RIO DE JANEIRO",
    "RN": "RIO GRANDE DO NORTE",
    "RO": "RONDONIA",
    "RR": "RORAIMA",
    "RS": "RIO GRANDE DO SUL",
    "SC": "SANTA CATARINA",
    "SE": "SERGIPE",
    "SP": "SAO PAULO",
    "TO": "TOCANTINS",
}


def state_name(code: Column) -> Column:
    """The name for `code`; a code without one passes through."""
    names = F.create_map(*[F.lit(x) for x in chain.from_iterable(STATE_NAMES.items())])
    return F.coalesce(names[code], code)
