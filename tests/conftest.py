"""One local session and a feed of small troubles."""

from __future__ import annotations

import io
import zipfile

import pytest

from priceloom.session import local_session

def zipped(payload: bytes, name: str = "feed.XML", **others: bytes) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for other, content in others.items():
            archive.writestr(other.replace("_", "."), content)
        if name:
            archive.writestr(name, payload)
    return buffer.getvalue()


def land(root, dt: str, hh: str, content: bytes, name: str = "instantane.xml.zip"):
    folder = root / f"dt={dt}" / f"hh={hh}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(content)


def feed(*stations: str) -> bytes:
    body = "".join(stations)
    return f'<?xml version="1.0" encoding="ISO-8859-1"?><pdv_liste>{body}</pdv_liste>'.encode("latin-1")


def station(id: str, *prices: tuple, cp: str = "34150", ville: str = "Gignac", lat: str = "4365000", lon: str = "355000") -> str:
    rows = "".join(f'<prix id="{i}" nom="{n}" maj="{m}" valeur="{v}"/>' for i, n, m, v in prices)
    return f'<pdv id="{id}" cp="{cp}" pop="R" latitude="{lat}" longitude="{lon}"><ville>{ville}</ville>{rows}</pdv>'


_MORNING, _NIGHT = "2026-04-30 08:05:09", "2026-04-30 23:50:00"

#: One station per kind of trouble, and a sound one; six errors, five good prices.
SAMPLE_FEED = feed(
    # without an id: its prices belong to nobody
    station("", ("5", "E10", _MORNING, "1.801"), ville="Nulle-Part"),
    # a fuel without a name
    station("42", ("1", "Gazole", _MORNING, "1.549"), ("2", "", _MORNING, "1.699")),
    # a decimal comma, and a value that is no number
    station("7", ("6", "SP98", _MORNING, "1,799"), ("3", "E85", _MORNING, "0.819"), ("5", "E10", _MORNING, "NaN"),
            cp="20137", ville="Lecci", lat="4168000", lon="932000"),
    # no place at all; a price set shortly before midnight
    station("1001", ("4", "GPLc", _NIGHT, "0.990"), cp="", ville=" ", lat="", lon=""),
    # sound, west of Greenwich, its town in blanks
    station("560", ("2", "SP95", _MORNING, "1.759"), ("1", "Gazole", _NIGHT, "1.640"),
            cp="29900", ville="  Île-aux-Grées ", lat="4787500", lon="-391700"),
    # a fuel without an id, and a date in another order: no price left
    station("8", ("", "Gazole", _MORNING, "1.5"), ("1", "Gazole", "30/04/2026 08:05", "1.5")),
).decode("latin-1")


@pytest.fixture(scope="session")
def spark():
    # Tiny data: compiling each plan would take longer than running it.
    session = local_session(4, "4g", **{"spark.sql.shuffle.partitions": "2", "spark.sql.codegen.wholeStage": "false"})
    yield session
    session.stop()
