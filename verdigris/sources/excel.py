"""The first sheet of an .xlsx file, read with the standard library: a zip of XML parts."""

from __future__ import annotations

import datetime as dt
import re
import zipfile
from collections.abc import Iterator
from typing import BinaryIO
from xml.etree import ElementTree

#: Built-in number formats that show dates or times (fixed values of the format).
DATE_FORMATS = {*range(14, 23), *range(45, 48)}
EPOCH = dt.datetime(1899, 12, 30)


def _tag(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _all(root: ElementTree.Element | None, name: str) -> Iterator[ElementTree.Element]:
    return (e for e in root.iter() if _tag(e) == name) if root is not None else iter(())


def _text(element: ElementTree.Element) -> str:
    """The text of all runs but phonetic guides."""
    if _tag(element) == "rPh":
        return ""
    own = element.text or "" if _tag(element) == "t" else ""
    return own + "".join(map(_text, element))


def _column(reference: str) -> int:
    n = 0
    for letter in re.match("[A-Z]*", reference)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def rows(file: str | BinaryIO) -> list[list[object]]:
    """The cells of the first sheet, row by row: text, numbers, truth values, dates, None."""
    with zipfile.ZipFile(file) as z:
        part = lambda name: ElementTree.fromstring(z.read(name)) if name in z.namelist() else None
        strings = [_text(e) for e in _all(part("xl/sharedStrings.xml"), "si")]
        styles = part("xl/styles.xml")
        own = {int(f.get("numFmtId")) for f in _all(styles, "numFmt") if re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "").lower()))}
        formats = [int(x.get("numFmtId", 0)) for group in _all(styles, "cellXfs") for x in group]
        links = {r.get("Id"): r.get("Target") for r in _all(part("xl/_rels/workbook.xml.rels"), "Relationship")}
        first = next(_all(part("xl/workbook.xml"), "sheet"))
        target = links[next(v for k, v in first.attrib.items() if k.endswith("}id"))]
        sheet = part(target.lstrip("/") if target.startswith("/") else f"xl/{target}")

    def value(cell: ElementTree.Element) -> object:
        kind, shown = cell.get("t"), next((e.text for e in cell if _tag(e) == "v"), None)
        if kind == "inlineStr":
            return "".join(_text(e) for e in cell if _tag(e) == "is")
        if shown is None or kind == "e":
            return None
        if kind == "s":
            return strings[int(shown)]
        if kind == "str":
            return shown
        if kind == "b":
            return shown == "1"
        style = int(cell.get("s", 0))
        number = float(shown)
        if style < len(formats) and formats[style] in DATE_FORMATS | own:
            return EPOCH + dt.timedelta(days=number)
        return int(number) if number.is_integer() else number

    out: list[list[object]] = []
    for row in _all(sheet, "row"):
        at = int(row.get("r", len(out) + 1)) - 1
        out += [[] for _ in range(at + 1 - len(out))]
        for nth, cell in enumerate(e for e in row if _tag(e) == "c"):
            k = _column(cell.get("r", "")) if cell.get("r") else nth
            out[at] += [None] * (k + 1 - len(out[at]))
            out[at][k] = value(cell)
    return out
