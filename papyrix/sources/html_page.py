"""Web pages to text, whole: only scripts, styles and markup go. (The main text alone is another operator's business.)"""

from __future__ import annotations

import re
from html.parser import HTMLParser

SILENT = {"script", "style", "noscript"}
# Tags behind which a new paragraph begins.
PARAGRAPH = set("p div section article header footer main aside nav ul ol li table tr h1 h2 h3 h4 h5 h6 blockquote figcaption".split())

_CHARSET = re.compile(rb"charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.I)
_BLANKS = re.compile(r"[^\S\n]+")


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.title: list[str] = []
        self.silent = self.in_title = 0

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent += 1
        elif tag == "title":
            self.in_title += 1
        elif tag == "br":
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag == "title":
            self.in_title = max(0, self.in_title - 1)
        elif tag in PARAGRAPH:
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.silent:
            (self.title if self.in_title else self.out).append(data)


def tidy(text: str) -> str:
    """Blanks become one space, lines are trimmed, at most one empty line stays between others."""
    lines = [line.strip() for line in _BLANKS.sub(" ", text).split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def page_text(page: str) -> tuple[str, str]:
    """(text, title)"""
    parser = _Text()
    parser.feed(page)
    parser.close()
    return tidy("".join(parser.out)), " ".join("".join(parser.title).split())


def decoded(content: bytes) -> str:
    named = _CHARSET.search(content[:4096])
    try:
        return content.decode(named[1].decode("ascii") if named else "utf-8", "replace")
    except LookupError:
        return content.decode("utf-8", "replace")


def load(content: bytes) -> list[dict]:
    text, title = page_text(decoded(content))
    return [{"text": text, "title": title or None, "metadata": {}}]
