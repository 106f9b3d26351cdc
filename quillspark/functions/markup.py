"""HTML to Markdown by a stateful parser, in Arrow batches; Spark has nothing of its own for nested markup."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What opens and closes a piece of text.
MARKS = {"strong": ("**", "**"), "b": ("**", "**"), "em": ("_", "_"), "i": ("_", "_"), "sup": ("^(", ")")}


class _Writer(HTMLParser):
    """Markdown so far, the numbers of open lists (None: bullets), the addresses of open links and the marks still to close."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.text = ""
        self.lists: list[int | None] = []
        self.links: list[str | None] = []
        self.open: list[str] = []

    def part(self) -> None:
        """A blank line, unless the text is empty or ends in one."""
        if self.text and not self.text.endswith("\n\n"):
            self.text += "\n" if self.text.endswith("\n") else "\n\n"

    def item(self) -> None:
        mark = "- "
        if self.lists and self.lists[-1] is not None:
            self.lists[-1] += 1
            mark = f"{self.lists[-1]}. "
        self.text += "\n" + "  " * max(0, len(self.lists) - 1) + mark

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in MARKS:
            self.text += MARKS[tag][0]
            self.open.append(MARKS[tag][1])
        elif tag in ("p", "div"):
            self.part()
        elif tag in ("ul", "ol"):
            self.lists.append(0 if tag == "ol" else None)
            self.part()
        elif tag == "li":
            self.item()
        elif tag == "a":
            self.links.append(dict(attrs).get("href"))
            self.text += "["
        elif tag == "br":
            self.text += "\n"

    def handle_endtag(self, tag: str) -> None:
        if tag in MARKS and self.open:
            self.text += self.open.pop()
        elif tag == "a":
            address = self.links.pop() if self.links else None
            self.text += f"]({address})" if address else "]"
        elif tag in ("p", "div", "ul", "ol"):
            if tag in ("ul", "ol") and self.lists:
                self.lists.pop()
            self.part()

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.text += re.sub(r"\s+", " ", data)


def convert(html: str | None) -> str:
    """Markdown of a piece of HTML: emphasis, raised text, nested lists, links and blank lines between blocks. Null and empty are
    empty, and what has no tag is only stripped."""
    if not html or "<" not in html or ">" not in html:
        return (html or "").strip()
    writer = _Writer()
    writer.feed(html)
    writer.close()
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", writer.text)).strip()


def html_to_markdown(html: Column) -> Column:
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(convert)

    return run(html)
