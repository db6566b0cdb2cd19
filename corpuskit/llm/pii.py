"""Personal data: base patterns, and a semi-Markov conditional random field for the forms that they don't cover.

The field scores whole segments. In the neighbourhood of a trigger (a digit or ``@``, or the word ``at`` set off as people write it to
hide an address) every span whose form may be an entity, and which is no longer than ``MOST_CHARS``, is a candidate; its features see the span
as a whole (number of digits, checksum, separators, brackets, the word before, what touches it). The types' weights are learned from generated
sentences by stochastic gradient ascent on the conditional likelihood, with forward and backward sums over segmentations. Decoding is Viterbi over the same lattice:
boundaries and types of all the entities of a neighbourhood are chosen jointly; a stretch outside entities scores 0. The types have no weights for what follows what: entities in
prose stand apart, and what one says of the next (a phone number after an address) the words before it say as well. A segment counts by its posterior over all segmentations.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import random
import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

from pyspark.sql import DataFrame

from corpuskit.llm.rows import documents, map_documents

KINDS = ("email", "ip", "card", "phone")
#: Bounded-entity decoding: a segment has at most so many characters, and neighbourhoods are cut so far from a trigger.
MOST_CHARS = 80
#: A decoded segment is added when the posterior probability, over all segmentations of its neighbourhood, of an entity of its type there, with these bounds or others that overlap them, is at least this.
LEAST_POSTERIOR = 0.5

_EMAIL_RIGHT = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_EMAIL_LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match of these can only begin where a run of digits does, so the look-behind changes nothing but the time on long runs.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[\[({ ][aA][tT][\])} ]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, in time linear in the text: a match begins where the run of address characters before its ``@`` does."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _EMAIL_LEFT:
            start -= 1
        m = _EMAIL_RIGHT.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, end))
        else:
            end = max(end, at + 1)
        at = text.find("@", end)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(number of the kind, start, end) of the four base patterns, by kind and then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


# Forms of candidates. Each is wide: whether a span is an entity, and where it ends, is for the field to say.
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^A-Za-z0-9]")
_NUMBER = re.compile(r"[+(]?[0-9][0-9 ().\-/]*[0-9]")
_HIDDEN_AT = re.compile(r" ?@ ?|\s?[\[({] ?at ?[\])}]\s?|\sat\s", re.I)
_HIDDEN_DOT = r"(?:\.|\s?[\[({] ?dot ?[\])}]\s?|\sdot\s)"
_HIDDEN_LEFT = re.compile(r"[A-Za-z0-9_%+-]+")  # of the reversed text
_HIDDEN_LEFT_DOT = re.compile(_HIDDEN_DOT + "$", re.I)
_HIDDEN_RIGHT = re.compile(r"[A-Za-z0-9-]+")
_HIDDEN_RIGHT_DOT = re.compile(_HIDDEN_DOT + r"[A-Za-z0-9-]+", re.I)
_GROUPS = r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}"
_IPV6 = re.compile(rf"(?<![\w:])(?:{_GROUPS}::(?:{_GROUPS})?|::{_GROUPS})(?![\w:])|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{{1,4}}:){{2,7}}(?::?[0-9A-Fa-f]{{1,4}}){{1,5}}(?![0-9A-Fa-f:])")
_BEFORE = {
    "phone": re.compile(r"(?:tel|telephone|phone|call|mobile|cell|fax|telefon|tél|téléphone|teléfono|handy|mobil)[.: ]*$", re.I),
    "card": re.compile(r"(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)(?:\s*(?:number|no|nr|nummer|num))?[.:# ]*$", re.I),
    "ip": re.compile(r"(?:ip|address|host|server|adresse)[: ]*$", re.I),
    "order": re.compile(r"(?:order|invoice|ref|version|isbn|no|nr|page|section|total|id|part|room)[.:# ]*$", re.I),
    "money": re.compile(r"[$€£¥]\s*$"),
}
_DATE = re.compile(r"(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:[0-9]{4}|[0-9]{2})|[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2})$")
_US = re.compile(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$")
_INTERNATIONAL = re.compile(r"00[1-9][0-9]?[ /-]")
_CARD_GROUPS = re.compile(r"[0-9]{4}([ ./-]+)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$")


def candidates(text: str, low: int, high: int) -> list[tuple[int, int, str]]:
    """(start, end, form) of the spans between ``low`` and ``high`` that may be entities: whole runs of digits and separators, and what remains when groups are cut off either end."""
    out: set[tuple[int, int, str]] = set()
    for m in _HIDDEN_AT.finditer(text, low, high):
        starts, a = [], m.start()
        while m.end() - a < MOST_CHARS and (word := _HIDDEN_LEFT.match(text[max(0, a - MOST_CHARS) : a][::-1])):
            a -= len(word[0])
            starts.append(a)
            dot = _HIDDEN_LEFT_DOT.search(text[max(0, a - 8) : a])
            if not dot:
                break
            a -= len(dot[0])
        right = _HIDDEN_RIGHT.match(text, m.end(), m.end() + MOST_CHARS)
        while starts and right:
            right = _HIDDEN_RIGHT_DOT.match(text, right.end(), right.end() + MOST_CHARS)
            if right:
                out |= {(a, right.end(), "hidden") for a in starts if right.end() - a <= MOST_CHARS}
    for m in _IPV6.finditer(text, low, high):
        out.add((m.start(), m.end(), "ipv6"))
    for m in _NUMBER.finditer(text, low, high):
        groups = [t for t in re.finditer(r"[+(]?[0-9]+\)?", m[0])]
        for i in range(len(groups)):
            a = m.start() + groups[i].start()
            for j in range(i, len(groups)):
                b = m.start() + groups[j].end()
                if b - a > MOST_CHARS:
                    break
                if sum(c.isdigit() for c in text[a:b]) >= 7:
                    out.add((a, b, "number"))
    return sorted(out)


def _is_ipv6(span: str) -> bool:
    try:
        ipaddress.IPv6Address(span)
    except ValueError:
        return False
    return True


def features(text: str, start: int, end: int, form: str) -> list[str]:
    """Names of the features of a segment, which are seen over the whole span and what touches it."""
    span, before = text[start:end], text[max(0, start - 24) : start]
    out = ["form=" + form]
    if before[-1:].isalnum() or text[end : end + 1].isalnum():
        out.append("inside a word")
    if re.search(r"[0-9][ .\-/]?\(?$", before) or re.match(r"[ .\-/]?[0-9]", text[end : end + 2]):
        out.append("touches digits")
    out += ["after " + k for k, r in _BEFORE.items() if r.search(before)]
    if form == "hidden":
        out.append("sign" if "@" in span else "bracketed" if re.search(r"[\[({]", span) else "words")
        out.append("dot words" if re.search(r"\bdot\b", span, re.I) else "dots")
        out.append("name of a domain" if re.search(r"(?:^|[^A-Za-z])(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$", span, re.I) else "no name of a domain")
        if re.match(r"\s?(?:\.|[\[({] ?dot|dot\s)[ ]?[A-Za-z0-9]", text[end : end + 8], re.I) or _HIDDEN_LEFT_DOT.search(before):
            out.append("goes on")
        return out
    if form == "ipv6":
        out.append(f"colons={min(8, span.count(':'))}")
        out.append("hex letters" if re.search("[A-Fa-f]", span) else "no hex letters")
        out.append("an address" if _is_ipv6(span) else "no address")
        return out
    digits = _NOT_DIGIT.sub("", span)
    n = len(digits)
    out.append(f"digits={n if n < 20 else 20}")
    if 13 <= n <= 19:
        out.append("luhn" if luhn(digits) else "no luhn")
        if _CARD_GROUPS.match(span):
            out.append("groups of four")
    if _US.match(span):
        out.append("3-3-4")
    if _INTERNATIONAL.match(span):
        out.append("00 prefix")
    if _DATE.match(span):
        out.append("date")
    if span[0] == "(" and ")" in span:
        out.append("area in brackets")
    if span.count("(") != span.count(")"):
        out.append("open bracket")
    if digits == span:
        out.append("bare digits")
    if span[0] == "+":
        out.append("plus")
    return out


Lattice = list[tuple[int, int, list[str]]]
Weights = dict[tuple[int, str], float]


def _score(weights: Weights, kind: int, names: list[str]) -> float:
    return sum(weights.get((kind, f), 0.0) for f in names)


def _add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b > -math.inf else a


def expectations(lattice: Lattice, weights: Weights) -> tuple[float, list[list[float]]]:
    """The log of the sum over segmentations, and the posterior of each candidate under each type."""
    cuts = sorted({x for a, b, _ in lattice for x in (a, b)})
    where = {x: k for k, x in enumerate(cuts)}
    scores = [[_score(weights, k, f) for k in range(len(KINDS))] for _, _, f in lattice]
    ends: list[list[int]] = [[] for _ in cuts]
    starts: list[list[int]] = [[] for _ in cuts]
    for c, (a, b, _) in enumerate(lattice):
        starts[where[a]].append(c)
        ends[where[b]].append(c)
    forward, backward = [0.0] * len(cuts), [0.0] * len(cuts)
    for k in range(len(cuts)):
        total = forward[k - 1] if k else 0.0
        for c in ends[k]:
            for s in scores[c]:
                total = _add(total, forward[where[lattice[c][0]]] + s)
        forward[k] = total
    for k in reversed(range(len(cuts))):
        total = backward[k + 1] if k + 1 < len(cuts) else 0.0
        for c in starts[k]:
            for s in scores[c]:
                total = _add(total, s + backward[where[lattice[c][1]]])
        backward[k] = total
    z = forward[-1] if cuts else 0.0
    return z, [[math.exp(min(0.0, forward[where[a]] + s + backward[where[b]] - z)) for s in scores[c]] for c, (a, b, _) in enumerate(lattice)]


def decode(lattice: Lattice, weights: Weights) -> list[tuple[int, int, int, float]]:
    """The best segmentation: (kind, start, end, score) of its entities."""
    cuts = sorted({x for a, b, _ in lattice for x in (a, b)})
    where = {x: k for k, x in enumerate(cuts)}
    best: list[tuple[float, tuple | None]] = [(0.0, None)] * len(cuts)
    ends: dict[int, list[int]] = {}
    for c, (_, b, _) in enumerate(lattice):
        ends.setdefault(where[b], []).append(c)
    for k in range(len(cuts)):
        best[k] = best[k - 1] if k else (0.0, None)
        for c in ends.get(k, ()):
            a, b, names = lattice[c]
            base, path = best[where[a]]
            for kind in range(len(KINDS)):
                s = _score(weights, kind, names)
                if base + s > best[k][0]:
                    best[k] = (base + s, (path, (kind, a, b, s)))
    out, path = [], best[-1][1] if cuts else None
    while path:
        path, found = path
        out.append(found)
    return out[::-1]


def _generated(seed: int, count: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Sentences with the entities in them, and others with numbers that are none."""
    r = random.Random(seed)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice(("ra", "to", "lin", "mes", "ka", "den", "por", "sil", "en", "a", "is")) for _ in range(r.randint(1, 4)))

    def number(n: int) -> str:
        body = str(r.randint(3, 6)) + digits(n - 2)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def grouped(s: str) -> str:
        sep = r.choice((" ", "-", ".", "  ", " - ", "/"))
        return sep.join(s[i : i + 4] for i in range(0, len(s), 4))

    def phone() -> str:
        a, b, c = str(r.randint(2, 9)) + digits(2), digits(3), digits(4)
        return r.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"00{r.randint(10, 99)} {a} {digits(3)} {c}", f"({a}){b}-{c}", f"+{r.randint(1, 99)} ({a}) {b}-{c}", f"+{r.randint(10, 99)} {digits(2)} {b} {c}"))

    def email() -> str:
        at = r.choice((" at ", " [at] ", "(at)", " (at) ", "[at]", " @ ", "@"))
        dot = r.choice((" dot ", " [dot] ", "(dot)")) if "@" not in at and r.random() < 0.8 else "."
        return word() + (r.choice((".", "_")) + word() if r.random() < 0.3 else "") + at + word() + dot + r.choice(("com", "org", "net", "de", "fr", "es"))

    def ip() -> str:
        if r.random() < 0.5:
            return ".".join(str(r.randint(0, 255)) for _ in range(4))
        return ":".join("%x" % r.randint(0x10, 0xFFFF) for _ in range(8)) if r.random() < 0.6 else r.choice(("2001:db8::%x:%x", "2001:db8::%x:%x", "fe80::%x", "%x::%x", "%x::", "::%x")).replace("%x", "{:x}").format(r.randint(1, 0xFFFF), r.randint(1, 0xFFFF))

    def none() -> str:
        return r.choice(
            (
                lambda: f"{r.choice(('order', 'invoice', 'ref', 'id', 'part', 'no.'))} {digits(r.randint(7, 19))}",
                lambda: f"{r.randint(1900, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}",
                lambda: f"{r.randint(10, 28)}.{r.randint(10, 12)}.{r.randint(1900, 2030)}",
                lambda: f"{r.choice('$€')}{r.randint(1, 99)} {digits(3)} {digits(3)}",
                lambda: digits(r.randint(7, 19)),
                lambda: digits(r.randint(7, 19)),
                lambda: f"{digits(3)} {digits(4)} {digits(3)} {digits(2)} {digits(4)}",
                lambda: f"{digits(3)} {digits(4)} {digits(3)} {digits(2)} {digits(4)}",
                lambda: f"isbn 978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}",
                lambda: f"{r.randint(1900, 2030)}-{r.randint(1900, 2030)} {digits(2)}",
                lambda: f"{word()} at {word()}. {word()}",
                lambda: f"{word()} at {word()}.{word()} {word()}",
                lambda: f"{word()} at {word()}. {word()} {r.choice(('de', 'es', 'net'))} {word()}",
                lambda: f"{r.randint(10, 23)}:{r.randint(10, 59)}:{r.randint(10, 59)}",
                lambda: grouped("4" + digits(15)),
            )
        )()

    cue = {0: ("write to ", "mail ", ""), 1: ("host ", "ip ", ""), 2: ("card ", "visa ", "card number: ", ""), 3: ("call ", "tel. ", "phone: ", "")}
    out = []
    for _ in range(count):
        text, gold = word(), []
        for _ in range(r.randint(1, 3)):
            text += " " + " ".join(word() for _ in range(r.randint(1, 4))) + " "
            kind = r.randint(0, 6)
            if kind > 3:
                text += none()
            else:
                text += r.choice(cue[kind])
                entity = email() if kind == 0 else ip() if kind == 1 else (lambda s: grouped(s) if r.random() < 0.7 else s)(number(16)) if kind == 2 else phone()
                gold.append((kind, len(text), len(text) + len(entity)))
                text += entity
            text += r.choice(("", ".", ",")) + " " + word()
        out.append((text, gold))
    return out


@lru_cache(maxsize=2)
def trained(sentences: int = 1500, passes: int = 4, rate: float = 0.3, decay: float = 1e-4, seed: int = 7) -> Weights:
    """Weights after stochastic gradient ascent on generated sentences; the same at every call."""
    weights: Weights = {}
    lattices = []
    for text, gold in _generated(seed, sentences):
        lattice = [(a, b, features(text, a, b, form)) for a, b, form in candidates(text, 0, len(text))]
        at = {(a, b): k for k, a, b in gold}
        lattices.append((lattice, [at.get((a, b)) for a, b, _ in lattice]))
    for step in range(passes):
        for lattice, truth in lattices:
            if not lattice:
                continue
            _, posterior = expectations(lattice, weights)
            for (_, _, names), p, gold in zip(lattice, posterior, truth):
                for kind in range(len(KINDS)):
                    g = (gold == kind) - p[kind]
                    if abs(g) > 1e-3:
                        for f in names:
                            key = (kind, f)
                            weights[key] = weights.get(key, 0.0) * (1 - decay) + rate / (1 + step) * g
    return weights


def neighbourhoods(text: str) -> list[tuple[int, int]]:
    """Disjoint stretches that hold every trigger and ``MOST_CHARS`` characters on both sides of it."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - MOST_CHARS), min(len(text), m.end() + MOST_CHARS)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def added_spans(text: str, weights: Weights, base: list[tuple[int, int, int]], least: float = LEAST_POSTERIOR) -> list[tuple[int, int, int]]:
    """Entities that the field finds and that overlap no base span."""
    taken = sorted((a, b) for _, a, b in base)
    ends = [b for _, b in taken]
    out = []
    for low, high in neighbourhoods(text):
        free = []
        for a, b, form in candidates(text, low, high):
            k = bisect_right(ends, a)
            if k == len(taken) or taken[k][0] >= b:
                free.append((a, b, features(text, a, b, form)))
        if free and (found := decode(free, weights)):
            _, posterior = expectations(free, weights)
            for kind, a, b, _ in found:
                near = range(bisect_left(free, a - MOST_CHARS, key=lambda c: c[0]), bisect_left(free, b, key=lambda c: c[0]))
                if sum(posterior[c][kind] for c in near if free[c][1] > a) >= least:
                    out.append((kind, a, b))
    return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_posterior: float = LEAST_POSTERIOR) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone (of base spans), base_sha256, spans, found (array of kind, start, end, base).

    Spans are in code points of the whole text, the end exclusive. A null or empty text has no span (empty ``spans`` and ``found``, the digest
    of the empty string). A very long text is scanned whole; what is held beside it is one neighbourhood. Rows may repeat; an empty table gives an empty result; other columns are ignored. The weights are
    learned once on the driver, from generated sentences only, and their number is that of the features.
    """
    weights = trained()

    def start():
        def columns(ids: list[int | None], texts: list[str | None]) -> list[list]:
            out: list[list] = [ids, [], [], [], [], [], [], []]
            for text in texts:
                base, added = [], []
                if text and _TRIGGER.search(text):
                    base = base_spans(text)
                    added = added_spans(text, weights, base, least_posterior)
                for k in range(4):
                    out[1 + k].append(sum(s[0] == k for s in base))
                out[5].append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans = sorted([(*s, True) for s in base] + [(*s, False) for s in added])
                out[6].append(listed([s[:3] for s in spans]))
                out[7].append([{"kind": KINDS[k], "start": a, "end": b, "base": own} for k, a, b, own in spans])
            return out

        return columns

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, found array<struct<kind:string,start:long,end:long,base:boolean>>"
    return map_documents(documents(docs, id_col, text_col), schema, start)
