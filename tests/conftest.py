"""The test session, and lakes of sample archives generated from the contracts."""

from __future__ import annotations

import io
import os
import sys
import tempfile
import zipfile
from collections.abc import Iterable, Mapping

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratum.contracts import ELECTION_TYPES, ELECTORAL_CONTRACTS, SOURCE_NAME  # noqa: E402

SMALL_SF = "/root/testdata/sf0.001"

#: Cells of a sample record by canonical column, as a source file has them.
CELLS = {
    "sigla_partido": " lua  nova ", "numero_partido": "77", "genero": "masculino", "cor_raca": "Negra",
    "quantidade_candidatos": "4", "status_renuncia": "1", "data_geracao": "2/3/2025", "hora_geracao": "8:05:30",
}
MONEY_CELL, PERCENT_CELL = "9.876,50", "33,30"
PLACES = {
    "municipal": {"esfera_partidaria": "municipal", "sigla_uf": "rj", "sigla_ue": "60011", "municipio": "Niterói"},
    "geral": {"esfera_partidaria": "estadual", "sigla_uf": "rj", "sigla_ue": "", "municipio": "-"},
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from stratum.session import build_session

    session = build_session(app="stratum-tests", master="local[2]", shuffle_partitions=1,
                            conf={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


def line(dataset: str, year: int, **cells: str) -> str:
    """A record of a dataset; ``cells`` replace sample cells by canonical name."""
    contract = ELECTORAL_CONTRACTS[dataset]
    out = []
    for column in contract.canonical_columns:
        sample = MONEY_CELL if column.startswith("valor_") else PERCENT_CELL
        known = {"ano_eleicao": str(year), **CELLS, **PLACES[ELECTION_TYPES[year]], **cells}
        out.append(known.get(column, sample))
    return ";".join(out)


def archive(year: int, lines: Mapping[str, Iterable[str]] | None = None, more: Mapping[str, str] | None = None,
            encoding: str = "utf-8", headers: Mapping[str, str] | None = None) -> bytes:
    """A year's ZIP: one sample record in each dataset unless ``lines`` has others; ``more`` members as text."""
    members = {}
    for dataset, contract in ELECTORAL_CONTRACTS.items():
        header = (headers or {}).get(dataset, ";".join(contract.source_columns))
        members[f"{dataset}_{year}.csv"] = "\n".join([header, *(lines or {}).get(dataset, [line(dataset, year)])]) + "\n"
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as target:
        for name, text in {**members, **(more or {})}.items():
            target.writestr(name, text.encode(encoding))
    return packed.getvalue()


def lake_of(*archives: tuple[int, bytes]) -> str:
    """A new lake whose bronze layer holds the archives, each under its year."""
    root = tempfile.mkdtemp(prefix="stratum-lake-")
    for number, (year, data) in enumerate(archives):
        folder = os.path.join(root, "bronze", SOURCE_NAME, f"ano_eleicao={year}", "raw")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, f"{number}.zip"), "wb") as out:
            out.write(data)
    return root


def lake_with(year: int = 2024, **lines: list[str]) -> str:
    return lake_of((year, archive(year, lines)))
