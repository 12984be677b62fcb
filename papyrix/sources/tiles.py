"""Vector tiles (protocol buffers, perhaps gzipped) to blocks of attributes; equal features of a layer count once."""

from __future__ import annotations

import gzip
import struct
from collections.abc import Iterator
from typing import Any


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, Any]]:
    """(number, value) of a message; values are numbers or bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire == 1:
            value, at = data[at : at + 8], at + 8
        elif wire == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif wire == 5:
            value, at = data[at : at + 4], at + 4
        else:
            raise ValueError(f"wire type {wire} in a tile")
        yield number, value


def _attribute(data: bytes) -> Any:
    for number, value in fields(data):
        match number:
            case 1:
                return value.decode("utf-8", "replace")
            case 2:
                return struct.unpack("<f", value)[0]
            case 3:
                return struct.unpack("<d", value)[0]
            case 4:
                return value - (1 << 64) if value >> 63 else value
            case 5:
                return value
            case 6:
                return (value >> 1) ^ -(value & 1)
            case 7:
                return bool(value)
    return None


def _packed(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        value, at = _varint(data, at)
        out.append(value)
    return out


def layers(content: bytes) -> Iterator[tuple[str, list[dict]]]:
    """(name, attributes of each feature)"""
    data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    for number, layer in fields(data):
        if number != 3:
            continue
        name, keys, values, tags = "", [], [], []
        for k, value in fields(layer):
            if k == 1:
                name = value.decode("utf-8", "replace")
            elif k == 2:
                tags.append(next((_packed(v) for n, v in fields(value) if n == 2), []))
            elif k == 3:
                keys.append(value.decode("utf-8", "replace"))
            elif k == 4:
                values.append(_attribute(value))
        yield name, [{keys[a]: values[b] for a, b in zip(t[::2], t[1::2])} for t in tags]


def shown(value: Any) -> str:
    if value is None:
        return ""
    return str(int(value)) if isinstance(value, float) and value.is_integer() else str(value).strip()


def load(content: bytes) -> list[dict]:
    blocks: dict[tuple, str] = {}
    total = 0
    for name, features in layers(content):
        for attributes in features:
            total += 1
            key = (name, tuple(sorted((k, shown(v)) for k, v in attributes.items())))
            blocks.setdefault(key, "\n".join([f"capa: {name}", *(f"{k}: {s}" for k, v in attributes.items() if (s := shown(v)))]))
    return [{"text": "\n\n".join(blocks.values()), "title": None, "metadata": {"n_elementos": total, "n_unicos": len(blocks)}}]
