"""Personal data in texts, also where it is disguised.

Base rules find e-mail addresses, IP addresses, card and phone numbers as they stand. Then the text
goes through transducers, each of which replaces pieces of it and remembers where they came from:

1. homoglyphs: characters that look like or are compatible with ASCII become it, invisible ones go;
2. spelled digits: digit words in four languages become digits, and what separates them goes;
3. at and dot disguises: "(at)", "[dot]", "name at host dot tld", spaces around the signs.

The same rules are applied to what comes out, and what they find is mapped back through the
transducers to characters of the source. Such a span is added unless a base span of its kind holds it
whole; base spans always stay. All rules and transducers take time linear in the text.

A bare "at" counts only between a name and a host whose dots are spelled and whose last label is a
listed domain, so that prose is left alone. An "O", "o", "I" or "l" between two digits is a digit.

Nulls: a null text is an empty one and null ids stay. Repeated rows each get their spans. An empty table
gives no rows. Texts are read whole. Other columns, whatever their names, are kept by `redact` and
not read by `scan`. Spans count code points, the end is exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.tables import lean, mapped, text_of

KINDS = ("email", "ip", "card", "phone")

# The rules are the plain patterns, written so that no run of characters is tried from every one of
# its positions: a run of digits from its start, an address from its @.
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int]


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of name@host.label: the name is what can be one, back from the @."""
    end, at = 0, text.find("@")
    while at >= 0:
        host = _HOST.match(text, at + 1)
        if host:
            start = at
            while start > end and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
                start -= 1
            if start < at:
                end = host.end()
                yield start, end
                at = text.find("@", end)
                continue
        at = text.find("@", at + 1)


def ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


RULES: tuple[Callable[[str], Iterator[Span]], ...] = (emails, ips, cards, phones)


class Edited:
    """A text and, for the pieces of it that replace others, where they and their sources are."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        """`edits` are (start, end, replacement) of `text` in order, without overlap."""
        parts, at, out = [], 0, 0
        self.to, self.until, self.start, self.end = [], [], [], []
        for start, end, new in edits:
            parts += (text[at:start], new)
            out += start - at
            self.to.append(out)
            out += len(new)
            self.until.append(out)
            self.start.append(start)
            self.end.append(end)
            at = end
        self.text = "".join([*parts, text[at:]])

    def source(self, span: Span) -> Span:
        """The smallest span of the source that has made all characters of `span`."""
        return self._place(span[0], first=True), self._place(span[1] - 1, first=False) + 1

    def _place(self, at: int, first: bool) -> int:
        i = bisect_right(self.to, at) - 1
        # Deletions make no character: the last edit that makes one decides.
        if i < 0:
            return at
        if at < self.until[i]:
            return self.start[i] if first else self.end[i] - 1
        return self.end[i] + at - self.until[i]


# Cyrillic and Greek letters that look like Latin ones, and marks that look like ASCII ones.
LOOKALIKES = dict(zip(
    "аеорсухіјѕԁһԛԝАВЕКМНОРСТУХІЈЅαορνικτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧıɡ‐‑‒–—―−․⁄∕∶＿۔。｡",
    "aeopcyxijsdhqwABEKMHOPCTYXIJSaopviktuxABEZHIKMNOPTYXig-------.//:_..."))


def fold(char: str) -> str:
    """ASCII for a character beyond it that is compatible with or looks like some; itself otherwise.
    Invisible characters give nothing."""
    if char in LOOKALIKES:
        return LOOKALIKES[char]
    kind = unicodedata.category(char)
    if kind == "Cf":
        return ""
    if kind == "Zs":
        return " "
    if kind in ("Nd", "No"):
        digit = unicodedata.digit(char, None)
        if digit is not None:
            return str(digit)
    plain = unicodedata.normalize("NFKC", char)
    return plain if plain.isascii() and not plain.isspace() else char


def homoglyphs(text: str) -> list[tuple[int, int, str]]:
    if text.isascii():
        return []
    folded = {c: fold(c) for c in set(text) if not c.isascii()}
    changed = "".join(c for c, new in folded.items() if new != c)
    if not changed:
        return []
    return [(m.start(), m.end(), folded[m[0]]) for m in re.finditer(f"[{re.escape(changed)}]", text)]


# Digit words of English, German, French and Spanish.
DIGIT_WORDS = {w: str(i % 10) for i, words in enumerate((
    "zero oh null zéro cero", "one eins un une uno", "two zwei zwo deux dos", "three drei trois tres",
    "four vier quatre cuatro", "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete",
    "eight acht huit ocho", "nine neun neuf nueve")) for w in words.split()}
REPEATS = {"double": 2, "triple": 3}
# Words for the signs in the same languages.
AT_WORDS = "at|arobase|arroba|klammeraffe"
DOT_WORDS = "dot|punkt|point|punto"
# Last labels that a bare "at" and "dot" may spell.
DOMAINS = set("com org net edu gov mil int info biz io co ai app dev me tv eu uk us ca au nz ie in de at ch fr be lu es mx ar "
              "it nl pt br pl cz se no dk fi ru jp cn kr test example".split())

_DIGIT = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_GAP = r"[ \t]{0,2}[ \t-][ \t]{0,2}"
_MANY = "|".join(REPEATS)
_ITEM = re.compile(rf"(?i)(?:({_MANY})[ -])?({_DIGIT})")
_RUN = re.compile(rf"(?i)\b(?:(?:{_MANY})[ -])?(?:{_DIGIT})(?:{_GAP}(?:(?:{_MANY})[ -])?(?:{_DIGIT}))*\b")
_DIGIT_BEFORE = re.compile(rf"[0-9]({_GAP})\Z")
_DIGIT_AFTER = re.compile(rf"({_GAP})[0-9]")
_DOT_BEFORE = re.compile(rf"(?i)(?:[ \t](?:{DOT_WORDS})|[\[({{<][ \t]{{0,3}}(?:{DOT_WORDS}|\.)[ \t]{{0,3}}[\])}}>])[ \t]{{0,3}}\Z")
_DOT_AFTER = re.compile(rf"(?i)[ \t]{{0,3}}(?:[ \t](?:{DOT_WORDS})[ \t]|[\[({{<][ \t]{{0,3}}(?:{DOT_WORDS}|\.)[ \t]{{0,3}}[\])}}>])")
_PLUS = re.compile(rf"(?i)\b(?:plus|más)[ -]{{1,3}}(?=(?:{_MANY}|{_DIGIT})\b|[0-9])")
_LETTER_DIGIT = re.compile(r"(?<=[0-9])[OoIl](?=[0-9])")
_AROUND = 16


def _spelled_runs(text: str) -> Iterator[tuple[int, int, str]]:
    """Digit words to digits, in runs. The space between a run and a digit beside it goes. One word
    alone is a digit only between digits or beside a disguised dot."""
    for m in _RUN.finditer(text):
        start, end = m.span()
        digits = "".join(DIGIT_WORDS[d.lower()] * REPEATS.get(many.lower(), 1) for many, d in _ITEM.findall(m[0]))
        before, after = text[max(0, start - _AROUND):start], text[end:end + _AROUND]
        left, right = _DIGIT_BEFORE.search(before), _DIGIT_AFTER.match(after)
        if len(digits) > 1 or (left and right) or _DOT_BEFORE.search(before) or _DOT_AFTER.match(after):
            yield (start - (len(left[1]) if left else 0), end + (len(right[1]) if right else 0), digits)


def _in_order(edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Edits by place; of edits that overlap the first one stays."""
    out: list[tuple[int, int, str]] = []
    for e in sorted(edits):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


def spelled_digits(text: str, hints: int = -1) -> list[tuple[int, int, str]]:
    """Digit words, a spelled plus before them and letters between digits."""
    edits = list(_spelled_runs(text)) if hints & SPELLED else []
    if hints & PLUSES:
        edits += [(m.start(), m.end(), "+") for m in _PLUS.finditer(text)]
    if hints & LETTERS:
        edits += [(m.start(), m.end(), "0" if m[0] in "Oo" else "1") for m in _LETTER_DIGIT.finditer(text)]
    return _in_order(edits)


_BRACKETED = re.compile(rf"(?i)[ \t]{{0,3}}[\[({{<][ \t]{{0,3}}(?:(?P<at>{AT_WORDS}|@|a)|(?P<dot>{DOT_WORDS}|\.))[ \t]{{0,3}}[\])}}>][ \t]{{0,3}}")
_BARE = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}(?: +dot +[A-Za-z0-9_%+-]{{1,64}}){{0,3}}[ _-]+(?P<at>{AT_WORDS})[ _-]+"
    rf"(?P<host>[A-Za-z0-9-]{{1,63}}(?:(?: +(?:{DOT_WORDS}) +|\.)[A-Za-z0-9-]{{1,63}}){{1,8}})")
_DOT = re.compile(rf"(?i)(?P<spelled>[ \t]+(?:{DOT_WORDS})[ \t]+)|\.")
_NUMBER_DOT = re.compile(rf"(?i)(?<=[0-9])[ \t]{{1,3}}(?:{DOT_WORDS})[ \t]{{1,3}}(?=[0-9])")
_SPACED = re.compile(r"(?<=[A-Za-z0-9])(?:[ \t]{1,3}@[ \t]{0,3}|@[ \t]{1,3})(?=[A-Za-z0-9-]{1,63}[ \t]{0,3}\.)")
_SPACED_DOT = re.compile(r"(?<=[A-Za-z0-9])[ \t]{1,3}\.[ \t]{0,3}(?=[A-Za-z0-9])")
_LABEL = re.compile(r"[A-Za-z0-9-]{1,63}")


def _spelled_dots(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    return [(d.start(), d.end(), ".") for d in _DOT.finditer(text, start, end) if d["spelled"]]


def _host_end(text: str, start: int, end: int) -> int:
    """Where the longest beginning of text[start:end] ends whose last label is a listed domain."""
    stop, dots = start, list(_DOT.finditer(text, start, end))
    for dot, after in zip(dots, [*(d.start() for d in dots[1:]), end]):
        if text[dot.end():after].lower() in DOMAINS:
            stop = after
    return stop


def signs(text: str, hints: int = -1) -> list[tuple[int, int, str]]:
    """Disguised at and dot signs to the signs."""
    edits: list[tuple[int, int, str]] = []
    if hints & BRACKETS:
        edits += [(m.start(), m.end(), "@" if m["at"] else ".") for m in _BRACKETED.finditer(text)]
    if hints & DOTS:
        edits += [(m.start(), m.end(), ".") for m in _NUMBER_DOT.finditer(text)]
    if hints & SPACES:
        for m in _SPACED.finditer(text):
            edits.append((m.start(), m.end(), "@"))
            at = m.end()
            while (label := _LABEL.match(text, at)) and (dot := _SPACED_DOT.match(text, label.end())):
                edits.append((dot.start(), dot.end(), "."))
                at = dot.end()
    if hints & DOTS and hints & ATS:
        for m in _BARE.finditer(text):
            dots = _spelled_dots(text, m.start("host"), _host_end(text, *m.span("host")))
            if dots:
                gap = m.start("at")
                while text[gap - 1] in " _-":
                    gap -= 1
                edits += [*_spelled_dots(text, m.start(), gap), (gap, m.start("host"), "@"), *dots]
    return _in_order(edits)


# What a text must match for a rule or a transducer to have work in it, as RE2 patterns, which
# Arrow tries on a whole batch. They look at the text as it stands, so a text that the first
# transducer changes is taken to match all.
SPELLED, PLUSES, LETTERS, BRACKETS, DOTS, ATS, SPACES, ADDRESSES = (1 << i for i in range(8))
_NEAR_DOT = rf"(?:{DOT_WORDS}|\.)"
HINTS = {
    SPELLED: rf"(?i)\b(?:{_DIGIT}|{_MANY})[ \t-]+(?:{_DIGIT})\b|[0-9][ \t-]+(?:{_DIGIT})\b"
             rf"|{_NEAR_DOT}[ \t\])}}>]+(?:{_DIGIT})\b|\b(?:{_DIGIT})[ \t\[({{<]+{_NEAR_DOT}",
    PLUSES: r"(?i)\b(?:plus|más)[ -]",
    LETTERS: r"[0-9][OoIl][0-9]",
    BRACKETS: rf"(?i)[\[({{<][ \t]*(?:{AT_WORDS}|@|a|{DOT_WORDS}|\.)[ \t]*[\])}}>]",
    DOTS: rf"(?i)[ \t](?:{DOT_WORDS})[ \t]",
    ATS: rf"(?i)[ _-](?:{AT_WORDS})[ _-]",
    SPACES: r"[A-Za-z0-9](?:[ \t]+@|@[ \t])",
    ADDRESSES: r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]",
}


def hints_of(texts: pa.Array) -> np.ndarray:
    """The hints of each text, as bits."""
    out = np.zeros(len(texts), np.int64)
    for bit, pattern in HINTS.items():
        out |= pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(np.int64) * bit
    return out


def find(text: str, hints: int = -1) -> list[tuple[int, int, int, bool]]:
    """(kind number, start, end, whether a base rule found it), by kind, then start."""
    chain: list[Edited] = []
    plain = text
    for transduce in (lambda t, _: homoglyphs(t), spelled_digits, signs):
        edits = transduce(plain, -1 if chain else hints)
        if edits:
            chain.append(Edited(plain, edits))
            plain = chain[-1].text
    out = []
    for kind, rule in enumerate(RULES):
        base = list(rule(text)) if rule is not ips or hints & ADDRESSES else []
        spans = dict.fromkeys(base, True)
        starts = [s for s, _ in base]
        for span in rule(plain) if chain else ():
            for step in reversed(chain):
                span = step.source(span)
            i = bisect_right(starts, span[0]) - 1
            if i < 0 or base[i][1] < span[1]:
                spans.setdefault(span, False)
        out += [(kind, s, e, own) for (s, e), own in sorted(spans.items())]
    return out


_SPANS = "array<struct<kind: int, start: long, end: long, base: boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and the spans of every row, by kind, then start."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = [[{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in find(t.as_py(), h)]
                     for t, h in zip(texts, hints_of(texts).tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _ARROW)], names=["doc_id", "found"])

    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType),
                                              T.StructField("found", T._parse_datatype_string(_SPANS))]))


def redacted(text: str, hints: int = -1) -> str:
    """The text with every span replaced by its kind; spans that overlap are replaced as one."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e, _ in find(text, hints)):
        if start >= at:
            out += (text[at:start], f"[{KINDS[kind].upper()}]")
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """`docs` with the spans in the text replaced by "[EMAIL]", "[IP]", "[CARD]" or "[PHONE]"."""
    place = docs.columns.index(text_column)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            texts = columns[place].fill_null("")
            columns[place] = pa.array([redacted(t.as_py(), h) for t, h in zip(texts, hints_of(texts).tolist())], texts.type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return mapped(docs, run)


def listed(found: Column, base: bool) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    if base:
        found = F.filter(found, lambda x: x["base"])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
