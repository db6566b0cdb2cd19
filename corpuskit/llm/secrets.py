"""Secret scan through a trigram inverted index.

Each rule is a regular expression. From its parse tree a Boolean query over trigrams is derived (an AND/OR tree that every matching text
satisfies). An index segment is a slice of documents: its whole texts, ASCII lower-cased, are laid end to end, and every
position whose trigram occurs in some rule's query gives a posting (trigram, document). The query is answered by intersecting and
uniting posting lists, and only the candidates are verified with the expression itself. A rule without mandatory trigrams (``hex``) scans
every text. Segments are local to a task, as shards of a search engine are: no exchange, and no posting leaves its segment.
"""

from __future__ import annotations

import hashlib
import re
import re._constants as rc
import re._parser as rp
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from corpuskit.llm.rows import documents, map_documents

#: An AND of trigrams and ORs; None asks nothing, so every document is a candidate.
Query = tuple | None


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    flags: int = re.ASCII
    #: What a match must satisfy besides; a match that fails is dropped.
    check: Callable[[re.Match], bool] | None = None


def _assigned(m: re.Match) -> bool:
    return len(m[2]) >= 6


#: In the order in which spans that start together are listed. The first three are the base; the others are the method's.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE, _assigned),
    Rule("access", r"AKIA[A-Z0-9]+", check=lambda m: len(m[0]) >= 20),
    # Every maximal run is one match of [0-9a-f]+, so runs that are too short need not be built.
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}"),
)
ADDED_RULES = (
    Rule("github", r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("github_pat", r"(?<![A-Za-z0-9_])github_pat_[A-Za-z0-9_]{40,}"),
    Rule("gitlab", r"(?<![A-Za-z0-9_])glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"(?<![A-Za-z0-9_])xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("google", r"(?<![A-Za-z0-9_])AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"),
    Rule("stripe", r"(?<![A-Za-z0-9_])[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"),
    Rule("temporary", r"(?<![A-Z0-9])ASIA[A-Z0-9]{16}(?![A-Z0-9])"),
    Rule("url_login", r"://[^\s/:@]++:[^\s/:@]{3,}+@[A-Za-z0-9]"),
)
RULES = BASE_RULES + ADDED_RULES
#: Exact strings that a part of an expression may stand for, before it is cut into trigrams.
MOST_STRINGS = 32
#: Bytes whose trigrams are looked up at once.
AT_ONCE = 1 << 20


def _lower(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def _trigrams(strings: set[str]) -> Query:
    """Every matching text holds one of the strings."""
    alternatives = []
    for s in strings:
        raw = s.encode()
        grams = {raw[i : i + 3] for i in range(len(raw) - 2)}
        if not grams:
            return None
        alternatives.append(("and", *sorted(grams)))
    return alternatives[0] if len(alternatives) == 1 else ("or", *sorted(alternatives))


def _and(a: Query, b: Query) -> Query:
    return b if a is None else a if b is None else ("and", a, b)


def trigram_query(pattern: str, flags: int = re.ASCII) -> Query:
    """The Boolean trigram query of an expression, over ASCII-lower-cased UTF-8."""

    def walk(nodes) -> tuple[set[str] | None, Query]:
        """The strings that the nodes match exactly, where they are few, and a query that every match satisfies."""
        exact: set[str] | None = {""}
        query: Query = None
        best: set[str] = {""}

        def close() -> None:
            nonlocal exact, query
            if exact is not None:
                query = _and(query, _trigrams(exact))

        for op, arg in nodes:
            part: set[str] | None = None
            inner: Query = None
            if op is rc.LITERAL:
                part = {_lower(chr(arg))}
            elif op is rc.IN:
                part = _set(arg)
            elif op is rc.SUBPATTERN:
                part, inner = walk(arg[-1])
            elif op is rc.BRANCH:
                branches = [walk(b) for b in arg[1]]
                if all(e is not None for e, _ in branches):
                    part = set().union(*(e for e, _ in branches))
                else:
                    queries = [q if e is None else _and(q, _trigrams(e)) for e, q in branches]
                    inner = None if any(q is None for q in queries) else ("or", *queries)
            elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT, rc.POSSESSIVE_REPEAT):
                low, high, what = arg
                e, q = walk(what)
                if (low, high) == (0, 1) and e is not None:
                    part = e | {""}
                elif low >= 1:
                    if e is not None and len(e) == 1:
                        part = {next(iter(e)) * low} if low == high else None
                        inner = None if part else _trigrams({next(iter(e)) * low})
                    else:
                        inner = q if e is None else _and(q, _trigrams(e))
            elif op in (rc.AT, rc.ASSERT, rc.ASSERT_NOT):
                continue
            query = _and(query, inner)
            if part is not None and exact is not None and len(part) * len(exact) <= MOST_STRINGS:
                exact = {a + b for a in exact for b in part}
                best = exact
            else:
                close()
                exact = part if part is not None and len(part) <= MOST_STRINGS else None
                if exact is None:
                    best = None
                    exact = {""}
                else:
                    best = None
        if best is None:
            close()
            return None, query
        return exact, query

    def _set(items) -> set[str] | None:
        out: set[str] = set()
        for op, arg in items:
            if op is rc.LITERAL:
                out.add(_lower(chr(arg)))
            elif op is rc.RANGE and arg[1] - arg[0] < MOST_STRINGS:
                out |= {_lower(chr(c)) for c in range(arg[0], arg[1] + 1)}
            else:
                return None
        return out if len(out) <= 4 else None

    exact, query = walk(rp.parse(pattern, flags))
    return query if exact is None else _and(query, _trigrams(exact))


def _grams(query: Query) -> set[bytes]:
    if query is None:
        return set()
    return set().union(*({x} if isinstance(x, bytes) else _grams(x) for x in query[1:]))


class Segment:
    """Postings of one slice of documents, for the trigrams in question only."""

    def __init__(self, texts: list[str], wanted: np.ndarray, number: dict[bytes, int]) -> None:
        self.count, self.number = len(texts), number
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        # Three zero bytes stand between texts; a trigram across them holds a zero byte and occurs in no query.
        buffer = np.frombuffer(b"\0\0\0".join(raw).lower() + b"\0\0\0", np.uint8)
        starts = np.cumsum([0] + [len(r) + 3 for r in raw[:-1]]) if raw else np.zeros(0, np.int64)
        found = [np.zeros(0, np.int64)]
        for begin in range(0, len(buffer) - 2, AT_ONCE):  # stretches that overlap by two bytes, so no trigram is cut
            part = buffer[begin : begin + AT_ONCE + 2]
            code = part[:-2].astype(np.int32) << 16
            code |= part[1:-1].astype(np.int32) << 8
            code |= part[2:]
            which = wanted[code]
            at = np.flatnonzero(which)
            doc = np.searchsorted(starts, at + begin, side="right") - 1
            found.append(np.unique(which[at].astype(np.int64) * max(1, self.count) + doc))
        pairs = np.unique(np.concatenate(found))
        gram, doc = np.divmod(pairs, max(1, self.count))
        cuts = np.searchsorted(gram, np.arange(1, len(number) + 2))
        self.postings = [doc[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def candidates(self, query: Query) -> np.ndarray:
        """Documents, ascending, that satisfy the query."""
        if query is None:
            return np.arange(self.count)
        lists = [self.postings[self.number[x]] if isinstance(x, bytes) else self.candidates(x) for x in query[1:]]
        out = lists[0]
        for other in lists[1:]:
            out = np.intersect1d(out, other, assume_unique=True) if query[0] == "and" else np.union1d(out, other)
        return out


class Scanner:
    """Expressions, queries and the table of trigrams of a set of rules."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = [(r.kind, re.compile(r.pattern, r.flags), r.check) for r in rules]
        self.queries = [trigram_query(r.pattern, r.flags) for r in rules]
        grams = sorted(set().union(*map(_grams, self.queries)))
        self.number = {g: k for k, g in enumerate(grams)}
        self.wanted = np.zeros(1 << 24, np.uint8 if len(grams) < 255 else np.uint16)
        for g, k in self.number.items():
            self.wanted[int.from_bytes(g, "big")] = k + 1

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Of each text its (start, number of the rule, end), in order."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        segment = Segment(texts, self.wanted, self.number)
        for k, ((_, regex, check), query) in enumerate(zip(self.rules, self.queries)):
            for d in segment.candidates(query):
                out[d] += [(m.start(), k, m.end()) for m in regex.finditer(texts[d]) if check is None or check(m)]
        for found in out:
            found.sort()
        return out


def listed(spans: list[tuple[int, int, int]], kinds: list[str]) -> str:
    return ",".join(f"{kinds[k]}:{start}:{end}" for start, k, end in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, found (array of kind, start, end).

    Spans are in code points of the whole text, the end exclusive. A null or empty text has no span (empty ``spans``, empty ``found``,
    the digest of the empty string). A very long text is indexed in stretches and verified whole. Rows may repeat; an empty table gives an empty result; other columns are ignored. ``rules``
    begin with the three base rules.
    """
    kinds = [r.kind for r in rules]

    def start():
        scanner = Scanner(rules)

        def columns(ids: list[int | None], texts: list[str | None]) -> list[list]:
            out: list[list] = [ids, [], [], [], [], [], []]
            for spans in scanner.spans([t or "" for t in texts]):
                base = [s for s in spans if s[1] < 3]
                for k in range(3):
                    out[1 + k].append(sum(s[1] == k for s in base))
                out[4].append(hashlib.sha256(listed(base, kinds).encode()).hexdigest())
                out[5].append(listed(spans, kinds))
                out[6].append([{"kind": kinds[k], "start": a, "end": b} for a, k, b in spans])
            return out

        return columns

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, found array<struct<kind:string,start:long,end:long>>"
    return map_documents(documents(docs, id_col, text_col), schema, start)
