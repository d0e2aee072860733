"""Structured payloads inside pages: scripts, assignments, JSON-LD, JS literals.

What a pattern can find stays in the JVM; bracket matching, JavaScript literals
and reference graphs need a parser and run as Arrow-batched pandas functions on
the one column they read.
"""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vernissage.functions.text import _col


def script_json(html: Column | str, script_id: str) -> Column:
    """Body of ``<script id=…>`` as a variant; null if it is missing or no JSON."""
    body = F.regexp_extract(_col(html), rf"(?is)<script\b[^>]*\bid\s*=\s*[\"']{script_id}[\"'][^>]*>(.*?)</script\s*>", 1)
    return F.try_parse_json(body)


def jsonld_blocks(html: Column | str) -> Column:
    """JSON-LD scripts of a page as an array of texts."""
    return F.regexp_extract_all(_col(html), F.lit(r"(?is)<script\b[^>]*application/ld\+json[^>]*>(.*?)</script\s*>"), 1)


def jsonld_objects(html: Column | str) -> Column:
    """Objects of all JSON-LD scripts, lists and graphs flattened; broken scripts are skipped."""

    def listed(v: Column) -> Column:
        whole = F.when(v.isNotNull(), F.array(v))
        return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), whole)

    def opened(v: Column) -> Column:
        return F.coalesce(F.try_variant_get(v, "$['@graph']", "array<variant>"), F.array(v))

    blocks = F.array_compact(F.transform(jsonld_blocks(html), lambda b: F.try_parse_json(b)))
    return F.flatten(F.transform(F.flatten(F.transform(blocks, listed)), opened))


def first_of_type(objects: Column, kind: str) -> Column:
    """First object whose ``@type`` is, or holds, the given one."""
    one = lambda v: F.try_variant_get(v, "$['@type']", "string")
    many = lambda v: F.try_variant_get(v, "$['@type']", "array<string>")
    return F.get(F.filter(objects, lambda v: F.coalesce(F.array_contains(many(v), kind), one(v) == kind, F.lit(False))), 0)


def twice_encoded(html: Column | str, script_id: str) -> Column:
    """Script whose JSON is a string that holds JSON again."""
    return F.try_parse_json(F.try_variant_get(script_json(html, script_id), "$", "string"))


def meta_content(html: Column | str, name: str) -> Column:
    """``content`` of a meta tag, in either order of its attributes."""
    h, n = _col(html), name.replace(":", "[:]")
    first = F.regexp_extract(h, rf"(?is)<meta\b[^>]*(?:property|name)\s*=\s*[\"']{n}[\"'][^>]*\bcontent\s*=\s*[\"']([^\"']*)", 1)
    second = F.regexp_extract(h, rf"(?is)<meta\b[^>]*\bcontent\s*=\s*[\"']([^\"']*)[\"'][^>]*(?:property|name)\s*=\s*[\"']{n}", 1)
    return F.nullif(F.coalesce(F.nullif(first, F.lit("")), second), F.lit(""))


def _string_at(text: str, at: int) -> tuple[str | None, int]:
    """The JSON string that opens at a place, and where it ends; None if there is none.

    Strings within scripts are read here and not by a pattern in the JVM: a
    pattern that repeats a choice recurses once for each character, and a long
    string would end the executor.
    """
    try:
        value, end = json.JSONDecoder(strict=False).raw_decode(text, at)
    except (ValueError, RecursionError):
        return None, at
    return (value, end) if isinstance(value, str) else (None, at)


_PUSH, _CLOSE = re.compile(r"\.push\(\s*\[\s*\d+\s*,\s*(?=\")"), re.compile(r"\s*\]\s*\)")


def _chunks_of(html: str | None) -> list[str]:
    found, text = [], html or ""
    for m in _PUSH.finditer(text):
        value, end = _string_at(text, m.end())
        if value is not None and _CLOSE.match(text, end):
            found.append(value)
    return found


def flight_chunks(html: Column | str) -> Column:
    """Strings pushed by streamed page rendering, unescaped, as one array."""
    return F.pandas_udf(lambda pages: pages.map(_chunks_of), T.ArrayType(T.StringType()))(_col(html))


def string_after(marker: str):
    """Function of pages: the string literal right after a marker, unescaped."""

    @F.pandas_udf(T.StringType())
    def found(pages: pd.Series) -> pd.Series:
        def one(html: str | None) -> str | None:
            at = (html or "").find(marker)
            return _string_at(html, at + len(marker))[0] if at >= 0 else None

        return pages.map(one)

    return found


_PAIR = re.compile(r'"(\w+)"\s*:\s*"((?:[^"\\]|\\.)*)"', re.S)


def pairs_after(html: Column | str, anchor: str) -> Column:
    """``"key":"value"`` pairs in all the text after an anchor, as a map; the first of a key wins, values stay as written."""

    @F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
    def found(pages: pd.Series) -> pd.Series:
        def one(text: str | None) -> dict[str, str] | None:
            at = (text or "").find(anchor)
            out: dict[str, str] = {}
            for m in _PAIR.finditer(text, at) if at >= 0 else ():
                out.setdefault(m[1], m[2])
            return out if at >= 0 else None

        return pages.map(one)

    return found(_col(html))


def blocked(status: Column, header: Column, body: Column, statuses: tuple[int, ...] = (403, 429, 503), keywords: tuple[str, ...] = ("captcha", "access denied", "unusual traffic", "verify you are human")) -> Column:
    """Why a response is a block page, or null: its status, a challenge header, or the first keyword in its first 16 KB."""
    start = F.lower(F.substring(body, 1, 16384))
    by_word = [F.when(start.contains(k), F.concat(F.lit("keyword:"), F.lit(k))) for k in keywords]
    return F.coalesce(F.when(status.isin(*statuses), F.concat(F.lit("status:"), status.cast("string"))), F.when(F.lower(header).contains("challenge"), F.lit("header")), *by_word)


def balanced(text: str, start: int) -> str | None:
    """The bracketed text that opens at ``start``; brackets in strings do not count."""
    closing = {"{": "}", "[": "]", "(": ")"}
    stack: list[str] = []
    i, n = start, len(text)
    while i < n:
        ch = text[i]
        if ch in "\"'`":
            i += 1
            while i < n and text[i] != ch:
                i += 2 if text[i] == "\\" else 1
        elif ch in closing:
            stack.append(closing[ch])
        elif stack and ch == stack[-1]:
            stack.pop()
            if not stack:
                return text[start : i + 1]
        i += 1
    return None


class _Literal:
    """Reader of JavaScript literals: objects, arrays, strings, numbers, dates, constants."""

    WORDS = {"true": True, "false": False, "null": None, "undefined": None, "NaN": None, "Infinity": None}
    ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "0": "\0"}

    def __init__(self, text: str):
        self.s, self.i = text, 0

    def fail(self) -> None:
        raise ValueError(f"no literal at {self.i}")

    def skip(self) -> None:
        while self.i < len(self.s) and self.s[self.i].isspace():
            self.i += 1

    def peek(self) -> str:
        self.skip()
        return self.s[self.i] if self.i < len(self.s) else ""

    def take(self, ch: str) -> bool:
        if self.peek() == ch:
            self.i += 1
            return True
        return False

    def word(self) -> str:
        self.skip()
        j = self.i
        while j < len(self.s) and (self.s[j].isalnum() or self.s[j] in "_$.+-"):
            j += 1
        out, self.i = self.s[self.i : j], j
        return out

    def value(self, depth: int = 0) -> Any:
        if depth > 200:
            self.fail()
        ch = self.peek()
        if ch == "{":
            return self.items(depth, "}", {})
        if ch == "[":
            return self.items(depth, "]", [])
        if ch and ch in "\"'`":
            return self.string()
        word = self.word()
        if word == "void":
            self.value(depth + 1)
            return None
        if word == "new":
            self.word()
            if not self.take("("):
                self.fail()
            inner = None if self.peek() == ")" else self.value(depth + 1)
            if not self.take(")"):
                self.fail()
            return inner
        if word in self.WORDS:
            return self.WORDS[word]
        if word.startswith("!"):
            self.fail()
        try:
            return int(word)
        except ValueError:
            return float(word)

    def items(self, depth: int, close: str, out: Any) -> Any:
        self.i += 1
        while not self.take(close):
            if isinstance(out, dict):
                key = self.string() if self.peek() in "\"'" else self.word()
                if not key or not self.take(":"):
                    self.fail()
                out[str(key)] = self.value(depth + 1)
            else:
                out.append(self.value(depth + 1))
            if not self.take(",") and self.peek() != close:
                self.fail()
        return out

    def string(self) -> str:
        quote, out = self.s[self.i], []
        self.i += 1
        while self.i < len(self.s):
            ch = self.s[self.i]
            self.i += 1
            if ch == quote:
                return "".join(out)
            if ch == "\\" and self.i < len(self.s):
                ch = self.s[self.i]
                self.i += 1
                if ch == "u" or ch == "x":
                    size = 4 if ch == "u" else 2
                    out.append(chr(int(self.s[self.i : self.i + size], 16)))
                    self.i += size
                    continue
                ch = self.ESCAPES.get(ch, ch)
            out.append(ch)
        self.fail()
        return ""


def parse_literal(text: str | None) -> Any:
    """Value of a JavaScript literal; None if it is none."""
    if not text:
        return None
    try:
        return _Literal(text).value()
    except (ValueError, IndexError, RecursionError):
        return None


#: Values of a resolved table at most, counted as often as they are written out; more are refused.
MAX_VALUES = 2_000_000


def resolve_references(table: list[Any]) -> Any:
    """Value of an array whose containers hold the indexes of their members.

    Members that are no index (texts, truth values, containers) stand for
    themselves. A value that is used many times is resolved once. What refers
    back to a container that is still being read is None, and so is an index
    the table does not have. Raises ``ValueError`` if the value, written out,
    had more than ``MAX_VALUES`` parts.
    """
    known: dict[int, tuple[Any, int]] = {}
    reading: set[int] = set()

    def member(at: Any) -> tuple[Any, int]:
        if isinstance(at, bool) or not isinstance(at, int):
            return at, 1
        if at in known:
            return known[at]
        if at in reading or not 0 <= at < len(table):
            return None, 1
        reading.add(at)
        out = container(table[at])
        reading.discard(at)
        if out[1] > MAX_VALUES:
            raise ValueError("the table is too large when written out")
        known[at] = out
        return out

    def container(node: Any) -> tuple[Any, int]:
        if isinstance(node, dict):
            parts = {k: member(v) for k, v in node.items()}
            return {k: v for k, (v, _) in parts.items()}, 1 + sum(n for _, n in parts.values())
        if isinstance(node, list) and node and isinstance(node[0], str):
            kind, rest = node[0], node[1:]
            if kind == "Date":
                return (rest[0] if rest else None), 1
            if kind in WRAPPERS:
                return member(rest[0]) if rest else (None, 1)
        if isinstance(node, list):
            items = [member(v) for v in node]
            return [v for v, _ in items], 1 + sum(n for _, n in items)
        return node, 1

    return member(0)[0] if table else None


#: Wrappers whose first member is the value.
WRAPPERS = frozenset(("Reactive", "ShallowReactive", "Ref", "ShallowRef", "EmptyRef", "EmptyShallowRef"))


def linked_objects(store: dict[str, Any], root: str, ref: str = "__ref") -> Any:
    """An entry of a store of objects, with ``{"__ref": key}`` replaced by the entry of that key.

    A reference back to an entry that is being read stays a reference.
    """

    def value(node: Any, path: tuple[str, ...]) -> Any:
        if isinstance(node, dict):
            key = node.get(ref)
            if isinstance(key, str) and len(node) == 1:
                return node if key in path or key not in store else value(store[key], (*path, key))
            return {k: value(v, path) for k, v in node.items()}
        return [value(v, path) for v in node] if isinstance(node, list) else node

    return value(store[root], (root,)) if root in store else None


def _json(value: Any) -> str | None:
    return None if value is None else json.dumps(value, ensure_ascii=False)


def assigned_udf(name: str, numbered: bool = False):
    """Function of pages: JSON text of what is assigned to ``name`` (followed by a number), read as a JavaScript literal."""

    @F.pandas_udf(T.StringType())
    def assigned(pages: pd.Series) -> pd.Series:
        at = re.compile(rf"(?<![\w.]){re.escape(name)}{'[0-9]+' if numbered else ''}\s*=\s*(?=[{{\[])")

        def one(html: str | None) -> str | None:
            m = at.search(html or "")
            body = balanced(html, m.end()) if m else None
            return _json(parse_literal(body))

        return pages.map(one)

    return assigned


def object_after(key: str):
    """Function of arrays of text chunks: JSON text of the first object that is the value of a key."""
    # The brace is part of the match, so values of other kinds are passed over.
    opening = re.compile(rf'{re.escape(json.dumps(key))}\s*:\s*{{')

    def one(parts: Any) -> str | None:
        text, reader = "" if parts is None else "".join(filter(None, parts)), json.JSONDecoder()
        for m in opening.finditer(text):
            try:
                _, end = reader.raw_decode(text, m.end() - 1)
            except (ValueError, RecursionError):
                continue
            return text[m.end() - 1 : end]
        return None

    return F.pandas_udf(lambda chunks: chunks.map(one), T.StringType())


def literal_with(marker: str, key: str):
    """Function of pages: JSON text of the first JavaScript object right after a marker that has a key."""

    @F.pandas_udf(T.StringType())
    def found(pages: pd.Series) -> pd.Series:
        def one(html: str | None) -> str | None:
            at = (html or "").find(marker)
            while at >= 0:
                value = parse_literal(balanced(html, at + len(marker)))
                if isinstance(value, dict) and value.get(key) is not None:
                    return _json(value)
                at = html.find(marker, at + 1)
            return None

        return pages.map(one)

    return found


class _Cards(HTMLParser):
    """Collects the texts and attributes of the elements inside every card."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self, card: str, parts: dict[str, tuple[str, str]]):
        super().__init__(convert_charrefs=True)
        self.card, self.parts = card, parts
        self.cards: list[dict[str, str]] = []
        self.depth = 0
        self.inside: list[tuple[str, int]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = {k: v or "" for k, v in attrs}
        classes = given.get("class", "").split()
        if not self.depth:
            if self.card not in classes:
                return
            self.cards.append({k: v for k, v in given.items() if k.startswith("data-")})
        if tag not in self.VOID:
            self.depth += 1
        for name, (where, what) in self.parts.items():
            if where == tag or where in classes:
                if what == "text":
                    if tag not in self.VOID and name not in self.cards[-1]:
                        self.cards[-1][name] = ""
                        self.inside.append((name, self.depth))
                elif what in given:
                    self.cards[-1].setdefault(name, given[what])

    def handle_endtag(self, tag: str) -> None:
        if self.depth and tag not in self.VOID:
            self.inside = [(n, d) for n, d in self.inside if d < self.depth]
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        for name, _ in self.inside:
            self.cards[-1][name] += data


def cards_udf(card: str, parts: dict[str, tuple[str, str]]):
    """Function of pages: one map per element of class ``card``.

    ``parts`` names for each value the class or tag of an element inside the
    card and its attribute, or ``text``. Data attributes of the card itself are
    kept under their names.
    """

    @F.pandas_udf(T.ArrayType(T.MapType(T.StringType(), T.StringType())))
    def cards(pages: pd.Series) -> pd.Series:
        def one(html: str | None) -> list[dict[str, str]]:
            p = _Cards(card, parts)
            p.feed(html or "")
            return [{k: " ".join(v.split()) for k, v in c.items()} for c in p.cards]

        return pages.map(one)

    return cards


@F.pandas_udf(T.StringType())
def resolved_json(tables: pd.Series) -> pd.Series:
    """JSON text of a reference-coded array of values; null for what is none or too large written out."""

    def one(text: str | None) -> str | None:
        try:
            table = json.loads(text) if text else None
        except ValueError:
            return None
        try:
            return _json(resolve_references(table)) if isinstance(table, list) and table else None
        except (ValueError, RecursionError):
            return None

    return tables.map(one)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("sample", T.StringType())])))
def leaf_paths(texts: pd.Series) -> pd.Series:
    """Paths of the leaves of a JSON text, with the first value of each; empty containers are leaves."""

    def walk(node: Any, path: str, out: dict[str, str]) -> None:
        if isinstance(node, dict) and node:
            for k, v in node.items():
                walk(v, f"{path}.{k}" if path else str(k), out)
        elif isinstance(node, list) and node:
            for v in node:
                walk(v, path + "[]", out)
        elif path not in out:
            out[path] = json.dumps(node, ensure_ascii=False)

    def one(text: str | None) -> list[dict[str, str]]:
        out: dict[str, str] = {}
        try:
            walk(json.loads(text), "", out) if text else None
        except (ValueError, RecursionError):
            return []
        return [{"path": k, "sample": v} for k, v in out.items()]

    return texts.map(one)
