"""Personal data in texts, also where it is disguised, with spans in the source's code points.

Identifiers are looked for twice: in the text as it is, and in what transducers make of it. The
transducers undo look-alike characters, invisible characters, spelled digits and ways to write @ and
dot; they remember which source characters each output came from, so spans are mapped back.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from scriptorium.llm.rows import packed, result_schema, with_text
from scriptorium.llm.words import chunks, word_hashes, word_spans

# The kinds in order, and the patterns of the base identifiers. Possessive digits and the
# look-behind change no match: a match can only start where a run of digits does, and so long runs cost
# no more than their length.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MAX_PART = 255
CARD_DIGITS, PHONE_DIGITS = range(13, 20), range(9, 16)

# Letters of other scripts that look like Latin ones, signs, digit words.
_LOOK_ALIKES = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅαονιΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                        "aeopcyxijshdqwABEKMHOPCTYXIJSaoviABEZHIKMNOPTYX"))
_SIGNS = {"․": ".", "。": ".", "﹒": ".", "﹫": "@", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
          " ": " ", " ": " ", " ": " ", " ": " "}
_DIGITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")


def _plain(code):
    """The ASCII character that a compatibility form or a digit of another script stands for, if any."""
    char = chr(code)
    folded = unicodedata.normalize("NFKC", char)
    if len(folded) == 1 and 32 < ord(folded) < 127:
        return folded
    digit = unicodedata.decimal(char, None)
    return None if digit is None else str(digit)


_ALIKE = {ord(k): v for k, v in {**_LOOK_ALIKES, **_SIGNS}.items()}
for _first, _last in ((0x660, 0x669), (0x6F0, 0x6F9), (0x966, 0x96F), (0xFF01, 0xFF5E), (0x1D400, 0x1D7FF)):
    _ALIKE.update((c, _plain(c)) for c in range(_first, _last + 1) if _plain(c))
_ALIKE_CHARS = frozenset(map(chr, _ALIKE))

_WORD = "(?:" + "|".join(_DIGITS) + ")"
_OPEN, _CLOSE = r"[ \t]{0,2}[(\[{<][ \t]?", r"[ \t]?[)\]}>][ \t]{0,2}"
_TOKENS = re.compile(
    rf"(?P<none>[​-‍⁠﻿­]+)|(?P<at>{_OPEN}(?:at|@){_CLOSE}|&(?:#0*64|#x0*40|commat);"
    rf"|(?<=[a-z0-9])[ \t]{{1,3}}at[ \t]{{1,3}}(?=[a-z0-9-]{{1,63}}(?:[ \t]{{1,3}}dot[ \t]{{1,3}}[a-z0-9-]{{1,63}})))"
    rf"|(?P<dot>{_OPEN}(?:dot|\.){_CLOSE}|&(?:#0*46|#x0*2e|period);|(?<=[a-z0-9])[ \t]{{1,3}}dot[ \t]{{1,3}}(?=[a-z0-9]))"
    rf"|(?P<plus>\bplus[ \t]{{1,2}}(?={_WORD}\b))"
    rf"|(?P<digits>\b{_WORD}(?:[ \t-]{{1,2}}{_WORD})*\b)", re.IGNORECASE | re.ASCII)
_A_WORD = re.compile(_WORD, re.IGNORECASE)


def _emails(text):
    end, at, before = 0, text.find("@"), 0
    while at >= 0:
        part = text[max(end, before):at]
        start = at - len(part) + len(part.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        before = at + 1
        at = text.find("@", max(before, end))


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text):
    return [c for c in text if "0" <= c <= "9"]


def base_spans(text):
    """(kind, start, end) of the identifiers that stand in a text as they are, by kind, then start."""
    found = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= MAX_PART for p in parts):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 2 * CARD_DIGITS.stop:
            digits = _digits(m.group())
            if len(digits) in CARD_DIGITS and _luhn(digits):
                found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if len(_digits(m.group())) in PHONE_DIGITS]
    return found


def _hash_of(word):
    data = np.frombuffer(word.encode(), np.uint8)
    return word_hashes(data, *word_spans(data, np.array([0, len(data)])))[0]


_DIGIT_HASHES = np.array([_hash_of(w) for w in _DIGITS])
_DOT_HASH, _PLUS_HASH = _hash_of("dot"), _hash_of("plus")
_HIDDEN = "​‌‍⁠﻿­"
# First bytes, in UTF-8, of the characters that a transducer changes; those of Latin letters are rare
# enough to be tested in full.
_FIRST = np.zeros(256, bool)
_FIRST[[c.encode()[0] for c in {*_ALIKE_CHARS, *_HIDDEN}]] = True
_OPENING, _OPENED = np.zeros(256, bool), np.zeros(256, bool)
_OPENING[list(b"([{<&")] = _OPENED[list(b"aA@dD. \t#cCpP")] = True


def may_be_disguised(chunk):
    """For each text of a chunk, whether a transducer could change it; never false where one does.

    That is: a character of the tables, a bracket or ampersand before what may be at or dot, the word
    dot, or a digit word beside another one, a number, plus or dot.
    """
    _, _, data, bounds, starts, _, hashes, firsts = chunk
    n = len(bounds) - 1
    at = [np.flatnonzero(_FIRST[data])]
    if len(data) > 1:
        at.append(np.flatnonzero(_OPENING[data[:-1]] & _OPENED[data[1:]]))
    dot, digit = hashes == _DOT_HASH, np.isin(hashes, _DIGIT_HASHES)
    near = dot | digit | (hashes == _PLUS_HASH) | ((data[starts] >= 48) & (data[starts] <= 57))
    beside = np.zeros(len(hashes), bool)
    beside[1:] |= near[:-1]
    beside[:-1] |= near[1:]
    at.append(starts[dot | digit & beside])
    places = np.concatenate(at)
    flagged = np.zeros(n, bool)
    flagged[np.searchsorted(bounds, places, "right") - 1] = True
    return flagged


def normalise(text):
    """The text without disguises and the places of its pieces, or None if nothing is disguised.

    The pieces are (output start, source start, source end, whether output and source run in step).
    """
    alike = text if text.isascii() or _ALIKE_CHARS.isdisjoint(text) else text.translate(_ALIKE)
    pieces, out, length, last = [], [], 0, 0

    def put(piece, start, end, in_step):
        nonlocal length
        if piece:
            pieces.append((length, start, end, in_step))
            out.append(piece)
            length += len(piece)

    for m in _TOKENS.finditer(alike):
        put(alike[last:m.start()], last, m.start(), True)
        kind, last = m.lastgroup, m.end()
        if kind == "digits":
            # One piece per digit word, so that a span can begin and end between them.
            for w in _A_WORD.finditer(alike, m.start(), m.end()):
                put(str(_DIGITS.index(w.group().lower())), w.start(), w.end(), False)
        else:
            put({"none": "", "at": "@", "dot": ".", "plus": "+"}[kind], m.start(), m.end(), False)
    if not last and alike is text:
        return None
    put(alike[last:], last, len(alike), True)
    return "".join(out), pieces


def disguised_spans(text):
    """(kind, start, end) in the source of identifiers that only the normalised text shows whole."""
    normal = normalise(text)
    if normal is None:
        return []
    plain, pieces = normal
    starts, found = [p[0] for p in pieces], []
    for kind, a, b in base_spans(plain):
        out, start, end, in_step = pieces[bisect_right(starts, a) - 1]
        source = start + a - out if in_step else start
        out, start, end, in_step = pieces[bisect_right(starts, b - 1) - 1]
        stop = start + b - out if in_step else end
        label = plain[a:b].rpartition(".")[2]
        if text[source:stop] != plain[a:b] and (kind or len(label) > 1 and label.isalpha()):
            found.append((kind, source, stop))
    return found


def all_spans(text, disguised=True):
    """Base and disguised spans, and the base spans alone; both by kind, then start."""
    base = base_spans(text)
    return (sorted(dict.fromkeys(base + disguised_spans(text))) if disguised else base), base


def write_spans(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def redact(text, spans):
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, last, end_of = [], 0, -1
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a < end_of:
            end_of = last = max(last, b)
            continue
        out += [text[last:a], f"[{KINDS[k].upper()}]"]
        end_of = last = b
    return "".join(out) + text[last:]


def _map_texts(docs, keep, text, schema, work):
    """``keep`` columns with what ``work(text, may be disguised)`` returns for each whole text, in tasks."""
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    names = [c.split()[0] for c in schema.split(", ")]
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            column = batch.column(len(keep))
            flags = [may_be_disguised(chunk) for chunk in chunks(column)]
            rows = [work(value.as_py(), flag) for value, flag in zip(column, np.concatenate(flags) if flags else [])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], *[pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]],
                [*keep, *names])

    return with_text(docs, keep, text).mapInArrow(run, result_schema(docs, keep, schema))


def _report(text, disguised):
    spans, base = all_spans(text or "", disguised)
    counts = [sum(k == i for k, _, _ in base) for i in range(len(KINDS))]
    return (*counts, hashlib.sha256(write_spans(base).encode()).hexdigest(), write_spans(spans),
            len(spans) - len(base))


def find_pii(docs, keep=("doc_id",), text="text"):
    """The ``keep`` columns with n_email, n_ip, n_card, n_phone and base_sha256 of the base spans, the
    ``spans`` of base and disguised identifiers, and n_disguised.

    Texts are read whole, in linear time. A null text counts as empty; repeated rows stay repeated.
    """
    return _map_texts(docs, keep, text, "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                      "base_sha256 string, spans string, n_disguised bigint", _report)


def redact_pii(docs, text="text"):
    """The documents with every identifier in ``text`` replaced by its kind; a null text stays null."""
    def work(value, disguised):
        return (None if value is None else redact(value, all_spans(value, disguised)[0]),)
    clean = _map_texts(packed(docs, F.col(text).alias("_text")), ("_doc",), "_text", "_redacted string", work)
    return clean.select(*[F.col("_redacted" if c == text else f"_doc.`{c}`").alias(c) for c in docs.columns])
