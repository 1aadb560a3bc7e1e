"""Wiki markup as a reader sees it."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_NOTE = re.compile(r"<ref\b[^<>]*?(?:/>|>(.*?)</ref\s*>)", re.S | re.I)
_BREAK = re.compile(r"</?(?:br|p|div|tr|td|th|li|ul|ol|hr|table|blockquote|gallery|center|h[1-6]|dd|dt|poem)\b[^<>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_FILE = re.compile(r"\[\[\s*(?:file|image|category|datei|bild|kategorie|fichier|catégorie|archivo|categoría)\s*:\s*([^\[\]|]*)", re.I)
_LINK = re.compile(r"\[\[:?(?:[^\[\]|]*\|)?([^\[\]]*)\]\]")
_EXTERNAL = re.compile(r"\[(?:https?|ftp)://\S+\s*([^\]]*)\]")
_ROW = re.compile(r"^[ \t:]*(?:\{\||\|-).*$", re.M)
_CELL = re.compile(r"(?<=[|!])(?:\s*[a-z]+\s*=\s*(?:\"[^\"\n]*\"|[\w%#]+))+\s*\|(?!\|)", re.I)
_TEMPLATE = re.compile(r"\{\{\s*[#:\w][^{}|]*(\||\}\})")
_NAMED = re.compile(r"\|\s*\w[\w -]*\s*=(?!=)")
_MAGIC = re.compile(r"__[A-Z]+__")
_INVISIBLE = re.compile("[­​‌‍⁠﻿]")
_WORD = re.compile(r"\w+")


def visible(text: str) -> Iterator[str]:
    """The visible text, then each footnote by itself.

    Link labels, template arguments and table cells are kept; tags, comments, template and file names, attributes,
    quotes and entities are not. Broken or unclosed markup is left as it stands.
    """
    if "<" in text:
        text = _COMMENT.sub("", text)
        notes = [m.group(1) for m in _NOTE.finditer(text) if m.group(1)]
        text = _NOTE.sub("", text)
    else:
        notes = []
    for part in (text, *notes):
        if "<" in part:
            part = _TAG.sub("", _BREAK.sub(" ", part))
        if "{" in part:
            part = _ROW.sub(" ", part)
            part = _TEMPLATE.sub(lambda m: " |" if m.group(1) == "|" else " ", part)
        if "|" in part or "!" in part:
            part = _NAMED.sub(" | ", _CELL.sub(" ", part)) if "=" in part else part
        if "[" in part:
            part = _FILE.sub("[[", part)
            n = 1
            while n:  # the innermost links go first; each pass takes at least one pair of brackets away
                part, n = _LINK.subn(r"\1", part)
            part = _EXTERNAL.sub(r"\1", part)
        part = part.replace("'''", "").replace("''", "")
        if "__" in part:
            part = _MAGIC.sub(" ", part)
        if "&" in part:
            part = html.unescape(part)
        yield part


def words(text: str) -> list[str]:
    """Runs of letters and digits in one case and one Unicode form."""
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFC", text))
    return _WORD.findall(text.casefold().replace("_", " "))
