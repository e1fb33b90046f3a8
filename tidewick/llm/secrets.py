"""Secrets found by regular expressions behind an inverted index of trigrams.

Every rule's expression is turned into a Boolean query over the trigrams that its matches must hold. The
index is split by documents: for each block of texts, the postings of the trigrams that any rule asks for
are built, intersected and united as the queries say, and only the candidates are verified with the
expression. A rule without mandatory trigrams scans every text. Nothing is shuffled, memory is bounded by
the block, and a lost task rebuilds its part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as _c, _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tidewick.llm.textblock import Block, blocks


@dataclass(frozen=True)
class Rule:
    """``group`` is what is redacted; matches with fewer than ``least`` characters in it are dropped."""

    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0


#: The base rules, in the order in which equal starts are listed. Fixed values.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         re.IGNORECASE | re.ASCII, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 0, 24))  # a run of 24 or more is a run that is long enough
_KEY = r"(?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----"
#: What may stand between the lines of a key: white space, escapes and marks of quoting.
_GAP = r"""(?:\s|\\[nrt]|["'`,;>#*+|])"""
#: Header and body up to the END line; without one, the header's fields and the runs of base64, the last one short.
_PRIVATE = (rf"-----BEGIN {_KEY}(?:(?:(?!-----)[\s\S])*-----END {_KEY}"
            rf"|(?:{_GAP}+[A-Z][A-Za-z-]*: [^\r\n\\]*)*(?:{_GAP}*[A-Za-z0-9+/=]{{16,}})+"
            rf"(?:(?:\s|\\[nrt])+[A-Za-z0-9+/=]+(?=\s*(?:[\r\n\\\"']|$)))?)?")
#: Further kinds, after the base ones.
MORE = (
    Rule("private_key", _PRIVATE),
    Rule("login_url", r"[a-z][a-z0-9+.-]*://[^/\s:@]+:([^/\s:@]+)@", 0, 1),
    Rule("git_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"))

#: A query is None (any text), a trigram, or ("and" / "or", queries).
Query = object
#: Most strings a part of an expression is spelled out to.
_SPELLED = 64


def _fold(text: str) -> str:
    return text.encode().lower().decode()


def _both(op: str, queries: list) -> Query:
    """``queries`` under one operator; an any text under "or" says nothing, under "and" it adds nothing."""
    if op == "or" and (not queries or None in queries):
        return None
    queries = list(dict.fromkeys(q for q in queries if q is not None))
    return queries[0] if len(queries) == 1 else (op, tuple(queries)) if queries else None


def _of_strings(strings: set[str]) -> Query:
    """Texts that hold one of the strings."""
    out = []
    for s in strings:
        data = s.encode()
        out.append(_both("and", [data[i:i + 3] for i in range(len(data) - 2)]))
    return _both("or", out)


def _spell(items) -> tuple[set[str] | None, Query]:
    """All strings of a sequence of parsed items if they are few, and what its matches must hold."""
    run, whole, must = {""}, True, []
    for op, arg in items:
        strings, query = _item(op, arg)
        if strings is not None and len(run) * len(strings) <= _SPELLED:
            run = {a + b for a in run for b in strings}
            continue
        must += [_of_strings(run), query if strings is None else _of_strings(strings)]
        run, whole = {""}, False
    must.append(_of_strings(run))
    return (run if whole else None), _both("and", must)


def _item(op, arg) -> tuple[set[str] | None, Query]:
    if op is _c.LITERAL:
        return {_fold(chr(arg))}, None
    if op is _c.IN and all(k is _c.LITERAL for k, _ in arg) and len(arg) <= 6:
        return {_fold(chr(v)) for _, v in arg}, None
    if op in (_c.AT, _c.ASSERT, _c.ASSERT_NOT):
        return {""}, None
    if op is _c.SUBPATTERN:
        return _spell(arg[3])
    if op is _c.BRANCH:
        parts = [_spell(x) for x in arg[1]]
        if all(s is not None for s, _ in parts) and sum(len(s) for s, _ in parts) <= _SPELLED:
            return set().union(*[s for s, _ in parts]), None
        return None, _both("or", [q for _, q in parts])
    if op in (_c.MAX_REPEAT, _c.MIN_REPEAT, _c.POSSESSIVE_REPEAT):
        least, most, inner = arg
        strings, query = _spell(inner)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, None
        if least == most and least <= 3 and strings is not None and len(strings) ** least <= _SPELLED:
            run = {""}
            for _ in range(least):
                run = {a + b for a in run for b in strings}
            return run, None
        return None, query if least else None
    return None, None


def trigram_query(rule: Rule) -> Query:
    """What texts with a match of the rule must hold, in lower case; None if that is nothing."""
    return _spell(_parser.parse(rule.pattern, rule.flags))[1]


def _trigrams(query: Query) -> set[bytes]:
    if isinstance(query, tuple):
        return set().union(*[_trigrams(q) for q in query[1]])
    return {query} if query else set()


class Index:
    """Postings of one block of texts for the trigrams that the queries ask for."""

    def __init__(self, block: Block, asked: np.ndarray):
        low = np.frombuffer(block.data.lower(), np.uint8).astype(np.uint32)
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:] if len(low) > 2 else low[:0]
        at = np.flatnonzero(asked[code])
        doc = np.searchsorted(block.begin, at, "right") - 1
        pairs = np.unique((code[at].astype(np.int64) << 32) | doc)
        codes, first = np.unique(pairs >> 32, return_index=True)
        self.postings = dict(zip(codes.tolist(), np.split(pairs & 0xFFFFFFFF, first[1:]))) if len(codes) else {}
        self.all = np.arange(len(block))

    def find(self, query: Query) -> np.ndarray:
        if query is None:
            return self.all
        if isinstance(query, bytes):
            return self.postings.get(int.from_bytes(query, "big"), self.all[:0])
        parts = [self.find(q) for q in query[1]]
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
        return out


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, trigram_query(r), re.compile(r.pattern, r.flags)) for r in rules]
        self.asked = np.zeros(1 << 24, bool)
        for _, query, _ in self.rules:
            for t in _trigrams(query):
                self.asked[int.from_bytes(t, "big")] = True

    def spans(self, block: Block) -> list[list[tuple]]:
        """For each text its (start, rule number, kind, end, redacted start, redacted end), in order."""
        out: list[list[tuple]] = [[] for _ in range(len(block))]
        index, texts = Index(block, self.asked), {}
        for number, (rule, query, pattern) in enumerate(self.rules):
            for i in index.find(query).tolist():
                if i not in texts:
                    texts[i] = block.texts[i].decode()
                for m in pattern.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[i].append((m.start(), number, rule.kind, m.end(), m.start(rule.group), m.end(rule.group)))
        for spans in out:
            spans.sort(key=lambda s: s[:2])
        return out


def listed(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end, _, _ in spans)


def _redacted(text: str, spans: list[tuple]) -> str:
    """The text with each secret as [kind]; secrets that overlap become one, named after the first."""
    out, done, last = [], 0, -1
    for _, _, kind, _, lo, hi in sorted(spans, key=lambda s: (s[4], s[1])):
        if lo < last:
            done = last = max(last, hi)
            continue
        out += [text[done:lo], f"[{kind}]"]
        done = last = hi
    return "".join(out) + text[done:]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined), found and redacted.

    ``found`` is an array of (kind, start, end); starts and ends count code points, ends are exclusive.
    ``redacted`` is the text with the secrets replaced by their kind, null if there is none. A null text is
    empty; repeated rows and missing doc_ids are rows like others; other columns are ignored.
    """
    base = [r.kind for r in BASE]
    found = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch, block in blocks(batches):
            spans = scanner.spans(block)
            own = [[s for s in x if s[2] in base] for x in spans]
            yield pa.record_batch(
                [batch.column("doc_id"), *[pa.array([sum(s[2] == k for s in x) for x in own], pa.int64()) for k in base],
                 pa.array([hashlib.sha256(listed(x).encode()).hexdigest() for x in own]),
                 pa.array([listed(x) for x in spans]),
                 pa.array([[{"kind": s[2], "start": s[0], "end": s[3]} for s in x] for x in spans], found),
                 pa.array([_redacted(t.decode(), x) if x else None for t, x in zip(block.texts, spans)], pa.string())],
                ["doc_id", *[f"n_{k}" for k in base], "base_sha256", "spans", "found", "redacted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
             "found array<struct<kind: string, start: int, end: int>>, redacted string")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``docs`` with secrets replaced in the text, and n_chars, where there is one, counted again.

    Rows without a secret stay as they are, null texts too.
    """
    number = {f.name: i for i, f in enumerate(docs.schema.fields)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch, block in blocks(batches):
            spans = scanner.spans(block)
            if any(spans):
                texts = batch.column("text").to_pylist()
                new = [_redacted(t, x) if x else t for t, x in zip(texts, spans)]
                batch = batch.set_column(number["text"], "text", pa.array(new, pa.string()))
                if "n_chars" in number:
                    kind = batch.column("n_chars").type
                    size = [len(t) if x else n for t, x, n in zip(new, spans, batch.column("n_chars").to_pylist())]
                    batch = batch.set_column(number["n_chars"], "n_chars", pa.array(size, kind))
            yield batch

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
