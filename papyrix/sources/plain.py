"""Text files and paragraphs of extracted pages."""

from __future__ import annotations

import re

_GAP = re.compile(r"\n\s*\n")


def decoded(content: bytes) -> str:
    for encoding in ("utf-8-sig", "cp1252"):
        try:
            return content.decode(encoding)
        except UnicodeDecodeError:
            continue
    return content.decode("utf-8", "replace")


def load(content: bytes) -> list[dict]:
    parts = map(str.strip, _GAP.split(decoded(content).replace("\r\n", "\n")))
    return [{"text": "\n\n".join(p for p in parts if p), "title": None, "metadata": {}}]


def page_paragraphs(page: str | None) -> list[str]:
    """Paragraphs of a page that a PDF reader gave: between blank lines, line ends inside become spaces."""
    return [p for p in (" ".join(part.split()) for part in _GAP.split(page or "")) if p]


def pages_document(pages: list[str], recognise=None, scanned_below: int = 200) -> dict:
    """A document of pages. If they hold next to no text, ``recognise()`` (OCR of all pages) is used, if it finds more."""
    text = "\n\n".join(p for page in pages for p in page_paragraphs(page))
    if recognise is not None and len(text.strip()) < scanned_below:
        other = "\n\n".join(p for page in recognise() for p in page_paragraphs(page))
        if len(other.strip()) > len(text.strip()):
            return {"text": other, "title": None, "metadata": {"ocr": "true", "n_pages": len(pages)}}
    return {"text": text, "title": None, "metadata": {"n_pages": len(pages)}}


def nearest_caption(figure_y: float, captions: list[tuple[float, str]], reach: float = 40.0) -> str | None:
    """The caption nearest to a figure, ``reach`` points away at most."""
    near = min(((abs(y - figure_y), text) for y, text in captions), default=None)
    return near[1] if near and near[0] <= reach else None
