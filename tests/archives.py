"""Test archives: delimited schedules, ZIPs of them, and SAS transport files (public layout TS-140)."""

from __future__ import annotations

import functools
import io
import math
import struct
import zipfile


def delimited(header: list[str], rows: list[list], encoding: str = "utf-8") -> bytes:
    lines = ["\t".join(header)] + ["\t".join("" if v is None else str(v) for v in row) for row in rows]
    return ("\n".join(lines) + "\n").encode(encoding)


def zipped(members: dict[str, bytes]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return buffer.getvalue()


@functools.cache
def _ibm_double(value: float | None) -> bytes:
    if value is None:
        return b"." + bytes(7)
    if value == 0:
        return bytes(8)
    sign = 0x80 if value < 0 else 0
    mantissa, exponent = math.frexp(abs(value))
    shift = -exponent % 4
    mantissa, exponent = mantissa / 2**shift, exponent + shift
    whole = int(mantissa * 2**56)
    return bytes([sign | (exponent // 4 + 64)]) + whole.to_bytes(7, "big")


def _record(text: str) -> bytes:
    return text.ljust(80).encode("ascii")


def _padded(data: bytes) -> bytes:
    return data + b" " * (-len(data) % 80)


def xport(columns: dict[str, list], width: int = 8) -> bytes:
    """A transport file; a column is text if any of its values is ``str`` or ``bytes``."""
    names = list(columns)
    texts = {n for n in names if any(isinstance(v, (str, bytes)) for v in columns[n])}
    stamp = "01JAN00:00:00:00"
    head = "HEADER RECORD*******{:<8}HEADER RECORD!!!!!!!"
    parts = [
        _record(head.format("LIBRARY") + "0" * 30),
        _record("SAS     SAS     SASLIB  9.4     test    " + " " * 24 + stamp),
        _record(stamp),
        _record(head.format("MEMBER") + "0" * 17 + "1600000000140"),
        _record(head.format("DSCRPTR") + "0" * 30),
        _record("SAS     CALL    SASDATA 9.4     test    " + " " * 24 + stamp),
        _record(stamp),
        _record(head.format("NAMESTR") + f"000000{len(names):04d}" + "0" * 20),
    ]
    descriptors = b""
    for i, name in enumerate(names):
        descriptors += struct.pack(
            ">hhhh8s40s8shhh2s8shhl52s",
            2 if name in texts else 1,
            0,
            width,
            i + 1,
            name.ljust(8).encode(),
            b" " * 40,
            b" " * 8,
            0,
            0,
            0,
            b"  ",
            b" " * 8,
            0,
            0,
            i * width,
            bytes(52),
        )
    parts += [_padded(descriptors), _record(head.format("OBS") + "0" * 30)]
    data = []
    for row in zip(*columns.values()):
        for name, value in zip(names, row):
            if name in texts:
                raw = value if isinstance(value, bytes) else (value or "").encode()
                data.append(raw.ljust(width))
            else:
                data.append(_ibm_double(value))
    return b"".join(parts) + _padded(b"".join(data))
