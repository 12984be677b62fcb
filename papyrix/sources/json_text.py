"""JSON files of scraped articles, and lists of records, to text."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

# Where an article's body may be, best first; text to add; keys of records that say nothing.
BODY_FIELDS = ("body_paragraphs", "sections", "content", "abstract", "body_text", "excerpt")
EXTRA_FIELDS = ("lists",)
SKIPPED_KEYS = frozenset({"status", "size_bytes", "size_mb", "from_cache", "error", "content_type", "scraped_at", "local_path"})
STUB_WORDS = 40


def flat(value: Any) -> str:
    """A value on one line: lists joined by semicolons, objects as "key: value"."""
    match value:
        case None:
            return ""
        case str():
            return value.strip()
        case list():
            parts = map(flat, value)
        case dict():
            parts = (f"{k}: {shown}" if (shown := flat(v)) else "" for k, v in value.items())
        case _:
            return str(value)
    return "; ".join(p for p in parts if p)


def paragraphs(value: Any) -> Iterator[str]:
    """The paragraphs of a body: a string, a list of strings or of {heading, paragraphs}, an object of bodies."""
    match value:
        case str() if value.strip():
            yield value.strip()
        case list():
            for item in value:
                if isinstance(item, dict):
                    if heading := flat(item.get("heading")):
                        yield heading
                    yield from paragraphs(item.get("paragraphs"))
                elif isinstance(item, str):
                    yield from paragraphs(item)
        case dict():
            for key, inner in value.items():
                if isinstance(inner, str) and inner.strip():
                    yield str(key).strip()
                yield from paragraphs(inner)


def article(value: dict) -> dict:
    """The title, the first body that isn't empty, extras, and the excerpt if that makes only a stub. The rest is metadata."""
    body, used = [], set()
    title = flat(value.get("title"))
    if title:
        body.append(title)
    bodies = {name: found for name in BODY_FIELDS if (found := list(paragraphs(value.get(name))))}
    for name in [*list(bodies)[:1], *EXTRA_FIELDS]:
        found = bodies.get(name) or list(paragraphs(value.get(name)))
        if found:
            body += found
            used.add(name)
    if "excerpt" not in used and sum(len(p.split()) for p in body) < STUB_WORDS:
        excerpt = flat(value.get("excerpt"))
        if excerpt and excerpt not in body:
            body.append(excerpt)
            used.add("excerpt")
    return {"text": "\n\n".join(body), "title": title or None, "metadata": {k: v for k, v in value.items() if k not in used}}


def records(values: list) -> dict:
    """A block of "key: value" lines for each record."""
    blocks = []
    for value in values:
        if isinstance(value, dict):
            lines = [f"{k}: {shown}" for k, v in value.items() if k not in SKIPPED_KEYS and (shown := flat(v))]
            blocks.append("\n".join(lines))
        else:
            blocks.append(flat(value))
    return {"text": "\n\n".join(b for b in blocks if b), "title": None, "metadata": {"n_registros": len(values)}}


def load(content: bytes) -> list[dict]:
    value = json.loads(content.decode("utf-8-sig"))
    if isinstance(value, dict):
        return [article(value)]
    if isinstance(value, list):
        return [records(value)]
    raise ValueError("neither an object nor a list")
