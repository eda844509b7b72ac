"""Tree walk for the few pages whose markup the regex path cannot take apart."""

from __future__ import annotations

from html.parser import HTMLParser
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F

from ..schemas import CODE_BLOCKS
from .html import BLOCK_TAGS

TREE_RESULT = f"struct<heading:string,title:string,content:string,paragraphs:string,code_blocks:{CODE_BLOCKS}>"

_DROPPED = {"script", "style", "nav", "footer", "header"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(BLOCK_TAGS)
_DIV_WORDS = ("content", "docs", "markdown")


class _PageReader(HTMLParser):
    """Keeps the text nodes of the first element of each interesting kind."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open_tags: list[tuple[str, list]] = []  # tag, captures it ends
        self.open_count: dict[str, int] = {}
        self.dropped = 0
        self.texts: dict[str, list[str]] = {}
        self.blocks: dict[str, list[dict]] = {}
        self.active: list[str] = []
        self.code: list[str] = []  # text nodes inside any ``pre``
        self.code_size = 0
        self.open_pres: list[dict] = []
        self.without_code: list[dict] = []  # open ``pre`` elements that had no ``code`` element yet
        self.pending: list[str] = []
        # Paragraphs of each kind: a heading's level, or 0, and the nodes.
        self.paragraphs: dict[str, list[tuple[int, list[str]]]] = {}

    def _flush(self):
        node = "".join(self.pending).strip()
        self.pending = []
        if node and not self.dropped:
            for kind in self.active:
                self.texts[kind].append(node)
                self.paragraphs[kind][-1][1].append(node)
            if self.open_pres:
                self.code.append(node)
                self.code_size += len(node)

    def _start_capture(self, kind, ends):
        if kind not in self.texts:
            self.texts[kind], self.blocks[kind], self.paragraphs[kind] = [], [], [(0, [])]
            self.active.append(kind)
            ends.append(kind)

    def _edge(self, tag, level=0):
        """The edge of a block begins another paragraph."""
        if tag in _BLOCK and not self.dropped:
            for kind in self.active:
                self.paragraphs[kind].append((level, []))

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in _VOID:
            self._edge(tag)
            return
        ends: list = []
        if tag in _DROPPED:
            self.dropped += 1
        elif not self.dropped:
            names = (dict(attrs).get("class") or "")
            if tag in ("main", "article", "body", "h1", "title"):
                self._start_capture(tag, ends)
            if tag not in ("html", "head", "title", "body", "meta", "link") and not self._inside("head"):
                self._start_outside_body()
            if tag == "div" and any(word in names.lower() for word in _DIV_WORDS):
                self._start_capture("div", ends)
            if tag == "pre":
                block = {"begin": self.code_size, "end": None, "language": None}
                for kind in self.active:
                    self.blocks[kind].append(block)
                self.open_pres.append(block)
                self.without_code.append(block)
                ends.append(block)
            if tag == "code":
                marked = [name for name in names.split() if name.startswith("language-")]
                for block in self.without_code:
                    block["language"] = marked[0].replace("language-", "") if marked else None
                self.without_code = []
            self._edge(tag, int(tag[1]) if tag in ("h1", "h2", "h3", "h4", "h5", "h6") else 0)
        self.open_tags.append((tag, ends))
        self.open_count[tag] = self.open_count.get(tag, 0) + 1

    def _inside(self, tag):
        return self.open_count.get(tag, 0) > 0

    def _start_outside_body(self):
        # A page without a body tag gets one at its first visible element or text.
        if "body" not in self.texts:
            self._start_capture("body", [])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._flush()
        if tag in ("body", "html") or not self._inside(tag):
            return  # what follows the end of the body still belongs to it
        while self.open_tags:
            name, ends = self.open_tags.pop()
            self.open_count[name] -= 1
            if name in _DROPPED:
                self.dropped -= 1
            self._edge(name)
            for item in ends:
                if isinstance(item, str):
                    self.active.remove(item)
                else:  # elements end in the reverse order of their beginnings
                    self.open_pres.pop()["end"] = self.code_size
                    if self.without_code and self.without_code[-1] is item:
                        self.without_code.pop()
            if name == tag:
                break

    def handle_comment(self, data):
        self._flush()

    def handle_data(self, data):
        visible = data.strip() and not self.dropped
        if visible and not self._inside("head") and not self._inside("title"):
            self._start_outside_body()
        self.pending.append(data)

    def result(self) -> dict:
        kind = next((k for k in ("main", "article", "div", "body") if k in self.texts), None)
        blocks = self.blocks.get(kind, [])
        code = "".join(self.code)
        codes = [(code[block["begin"] : block["end"]], block["language"]) for block in blocks]
        return {
            "heading": "".join(self.texts["h1"]) if "h1" in self.texts else None,
            "title": "".join(self.texts["title"]) if "title" in self.texts else None,
            "content": " ".join(" ".join(self.texts[kind]).split()) if kind else None,
            "paragraphs": "\n\n".join(
                "#" * level + (" " if level else "") + " ".join(" ".join(nodes).split()) for level, nodes in self.paragraphs[kind] if nodes
            ) if kind else None,
            "code_blocks": [{"code": text, "language": language} for text, language in codes if text],
        }


def read_page(html: str | None) -> dict:
    if html is None:
        return {"heading": None, "title": None, "content": None, "paragraphs": None, "code_blocks": None}
    reader = _PageReader()
    reader.feed(html)
    reader.close()
    reader._flush()
    return reader.result()


def _walk(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for html in pages:
        yield pd.DataFrame(
            [read_page(page) for page in html], columns=["heading", "title", "content", "paragraphs", "code_blocks"]
        )


def tree_result(html: Column) -> Column:
    """Null input (a page that does not need the walk) costs one null in the Arrow batch."""
    return F.pandas_udf(_walk, TREE_RESULT)(html)
