"""Sentence boundaries across languages and scripts, by a finite transducer over boundary symbols.

Each mark of a text becomes a symbol by what stands near it: at most `CONTEXT` characters on either side. What no bounded
context tells is carried. From the right, an automaton tells which closing marks are still to come in the paragraph,
however far away, so that a mark without a partner opens nothing. From the left, the transducer knows whether a unit is
open, which quotation is, whether that began the unit, and whether the line is of a list. A chunk of a text is a function
of either, so chunks are read apart and their functions composed by a scan; each chunk's units then follow from the
states at its ends. Every text is read in chunks; those of a very long one in tasks of their own.
"""

from __future__ import annotations

import re
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTEXT = 2048
#: Characters of a chunk in a task's own texts, and of a chunk that is a row of its own.
CHUNK, ROW = 2048, 1 << 16
#: Characters of a line that a wrap leaves at least, and of a line beyond which its beginning no longer matters.
WRAPPED, LONG_LINE = 50, 900

# Common abbreviations in lower case without their last stop. The first never end a sentence inside a line;
# the second end one if the next word begins like a sentence.
INSIDE = set(
    """mr mrs ms dr prof st fig figs no nos vol vols p pp cf i.e e.g approx dept ed eds est vs viz ch sec art ref
    m mm mme mmes mlle mlles pr me env chap éd ex c.-à-d c-à-d p.ex n t av bd tél réf coll trad
    hr fr frl nr bd s abb z.b d.h u.a.m ca vgl bzw evtl ggf inkl zzgl str geb gest sog tel i.d.r o.ä z.t v.a hrsg aufl kap
    sr sra srta sres dra pág págs p.ej núm núms cap caps aprox ej ud uds vd vds av avda
    jan feb mar apr jun jul aug sep sept oct nov dec janv févr avr juil juill oct déc febr okt dez ene en mzo abr my ago ag dic
    κ κα κκ δηλ π.χ σελ αρ βλ χιλ εκ κεφ τόμ παρ λεωφ δρ καθ ιαν φεβρ μαρτ απρ ιουν ιουλ αυγ σεπτ οκτ νοε δεκ
    د أ أ.د ص م ج ط هـ ق.م ب.م
    พ.ศ ค.ศ น ดร รศ ผศ ศ นพ พญ ด.ช ด.ญ น.ส ม.ร.ว ต.ค ม.ค ก.พ มี.ค เม.ย พ.ค มิ.ย ก.ค ส.ค ก.ย พ.ย ธ.ค ม ซม กม กก""".split()
)
EITHER = set("""etc usw usf ff a.m p.m am pm min mins std sek sec h u.a κτλ κ.λπ κ.ά π.μ μ.μ jr inc ltd co corp uds ee.uu إلخ""".split())
#: German words before a number with a stop that is an ordinal; months after one.
BEFORE_ORDINAL = set("im am vom zum zur der die das dem den des beim ab bis seit jeder jede jedes jedem ins auf".split())
MONTHS = set("januar jänner februar märz april mai juni juli august september oktober november dezember jan jan. feb. febr. mär. apr. aug. sept. okt. nov. dez.".split())

BLANK = r"\s\u200b\u2060\ufeff"
STOPS = ".!?…。！？｡।॥؟;\u037e"
PAIRS = ("«»", "“”", "„“", "„”", "「」", "『』", "‹›", '""', "»«")
QUOTES = "".join(sorted({c for p in PAIRS for c in p}))
#: Closing marks as bits; two of them can close the same opening one.
CLOSING = {c: 1 << k for k, c in enumerate(sorted({p[1] for p in PAIRS}))}
OPENED_BY = {c: [i for i, p in enumerate(PAIRS) if p[0] == c] for c in QUOTES}
CLOSED_BY = {c: [i for i, p in enumerate(PAIRS) if p[1] == c] for c in QUOTES}
THAI = r"฀-๿"
CJK = r"぀-ヿ㐀-䶿一-鿿豈-﫿"
LINE_END = r"(?:\r\n|[\r\n\x0b\x0c\x1c-\x1e\x85\u2028\u2029])"
_PLAIN = f"[^{re.escape(STOPS + QUOTES)}\r\n\x0b\x0c\x1c-\x1e\x85\u2028\u2029{{}}]"
_TOKEN = rf"(?P<line>[{BLANK}]*{LINE_END}[{BLANK}]*)|(?P<stop>[{re.escape(STOPS)}]+)|(?P<quote>[{re.escape(QUOTES)}])"
TOKEN = re.compile(rf"{_TOKEN}|(?P<text>{_PLAIN.format('')}+)")
TOKEN_THAI = re.compile(rf"{_TOKEN}|(?P<text>{_PLAIN.format(BLANK)}+)|(?P<blank>[{BLANK}]+)")
HAS_THAI = re.compile(f"[{THAI}]")
FIRST = re.compile(rf"[^{BLANK}]")
CLOSERS = re.compile(r"[)\]}）］】〉》’'”»]*")
LINES = re.compile(LINE_END)
OTHER_BREAK = re.compile(r"[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
BULLET = re.compile(rf"(?:[-–—•*·・▪◦‣►■□○●✓✔][{BLANK}]|[・•])")
NUMBERED = re.compile(rf"\(?(?:\d{{1,3}}|[a-zA-Z]|[ivx]{{1,5}})(?:\)[{BLANK}]|[、．])|[①-⑳]")
POINTED = re.compile(rf"\d{{1,3}}\.[{BLANK}]+\S")
LAST_WORD = re.compile(r"[^\W_]+(?:[.\-'’][^\W_]+)*$")
NAME, FILE_NAME, TEXT_WORD, NEXT_WORD = re.compile(r"[^\s]+"), re.compile(r"[^\W\d_]+\d+_|\w+_\w+\.\w"), re.compile(r"[^\W\d_]+"), re.compile(r"[^\W\d_]+\.?")
GREEK, INDIC, OF_CJK, AFTER_ASKED = re.compile(r"[Ͱ-Ͽἀ-῿]"), re.compile(r"[ऀ-෿]"), re.compile(f"[{CJK}]"), re.compile(f"[{CJK}{QUOTES}¿¡)’']")
DATE, MERIDIEM, ENDS_CJK, BEGINS_CJK, LOW_NAME = re.compile(r"\d{1,2}\.\s?\d{2,4}\b"), re.compile(r"(?:\b[ap]\. ?m|[πμ]\. ?μ)$"), re.compile(f"[{CJK}]$"), re.compile(f"[{CJK}「『“]"), re.compile(r"[a-z]\d+_")
ENDS_THAI, THAI_SIGN, THAI_DIGIT, BEYOND = re.compile(f"[{THAI}]$"), re.compile(r"[\d๐-๙.]"), re.compile(r"[๐-๙]"), re.compile(r"[\d.,:]+[^\S\r\n]*([^\W\d_])")
WORD_END, WORD_START, PARTICLE = re.compile(r"\S*$"), re.compile(r"\S*"), re.compile(r"(?:と|って|という|との|とか|を|に|が|は|の|も|で|等|など)")
ENDING = re.compile(rf"[.!?…。！？｡।॥؟][{re.escape(QUOTES)}’')\]）]*$")

SYMBOLS = ["text", "stop", "hard", "break", "list", "thai", "swap", "swaplast", *(f"{k}{i}" for i in range(len(PAIRS)) for k in ("open", "close", "last"))]
SYMBOL = {s: k for k, s in enumerate(SYMBOLS)}
#: Unit open, quotation open (0 none), it began the unit, line of a list.
STATES = [s for s in product((0, 1), range(len(PAIRS) + 1), (0, 1), (0, 1)) if s[1] or not s[2]]
QUOTE, PARAGRAPH, STOP = -1, -2, SYMBOL["stop"]
STATE = {s: k for k, s in enumerate(STATES)}
START, STARTS, ENDS_BEFORE, ENDS_AFTER = STATE[0, 0, 0, 0], 1, 2, 4


def _step(state: tuple, symbol: str) -> tuple[tuple, int]:
    """The rules: what a symbol does in a state."""
    is_open, quote, first, listed = state
    if symbol in ("hard", "break"):
        return (0, 0, 0, 0), ENDS_BEFORE * is_open
    if symbol == "list":
        return (0, 0, 0, 1), ENDS_BEFORE * is_open
    if symbol == "thai":
        return ((0, 0, 0, 0), ENDS_BEFORE) if is_open and not quote and not listed else (state, 0)
    begins = STARTS * (1 - is_open)
    if symbol[:4] == "swap":  # opens in the German manner, or closes in the French one
        symbol = "open8" if not quote else ("last0" if symbol == "swaplast" else "close0") if quote == 1 else "text"
    if symbol[:-1] == "open" and not quote:
        return (1, int(symbol[-1]) + 1, 1 - is_open, listed), begins
    if symbol[:-1] in ("close", "last") and quote == int(symbol[-1]) + 1:
        ends = symbol[:-1] == "last" and not first and not listed
        return ((0, 0, 0, 0), ENDS_AFTER) if ends else ((1, 0, 0, listed), 0)
    if symbol == "stop" and is_open and not quote and not listed:
        return (0, 0, 0, 0), ENDS_AFTER
    return (1, quote, first, listed), begins


def _compile() -> tuple[np.ndarray, np.ndarray]:
    made = [[_step(s, x) for x in SYMBOLS] for s in STATES]
    return np.array([[STATE[s] for s, _ in row] for row in made], dtype=np.int16), np.array([[o for _, o in row] for row in made], dtype=np.int8)


NEXT, OUT = _compile()
_NEXT, _OUT = NEXT.tolist(), OUT.tolist()


def _word_before(text: str, at: int) -> str:
    """The word, with inner stops, that ends at a stop."""
    if at and text[at - 1] == "\n":
        at -= 1
    if not at or text[at - 1].isspace():
        return ""
    m = LAST_WORD.search(text[max(0, at - 40) : at].rsplit(None, 1)[-1])  # a word holds no blank
    return m[0] if m else ""


def _like_start(text: str, at: int) -> bool:
    """Whether what stands at a position can begin a sentence: no lower-case word, but a name of a file may."""
    c = text[at]
    if c.islower():
        m = NAME.match(text, at, at + 60)
        return bool(FILE_NAME.match(m[0]))
    return c.isalnum() or c in "¿¡([（【#§" + QUOTES


def _is_stop(text: str, a: int, b: int) -> bool:
    """Whether the stops text[a:b] end a sentence if no quotation holds them."""
    mark, size = text[a:b], len(text)
    if set(mark) & set("。！？｡।॥؟"):
        return True
    before = text[a - 1] if a else " "
    m = FIRST.search(text, b, min(size, b + 200))
    follows = m.start() if m else size
    if ";" in mark or "\u037e" in mark:  # the Greek question mark
        return bool(GREEK.match(before)) and (follows > b or follows == size) and set(mark) <= set(";\u037e!?")
    if "!" in mark or "?" in mark:
        return follows > b or follows >= size or text[b].isupper() or bool(AFTER_ASKED.match(text[b]))
    if "…" in mark or len(mark) > 1:  # dots of omission
        if follows >= size:
            return True
        word = text[follows : follows + 2]
        return follows > b and word[0].isupper() and word[1:].islower()
    if follows >= size and not m:
        return True
    if follows == b:  # no blank
        if text[b].isupper() and b + 1 < size and text[b + 1].islower():
            word = _word_before(text, a)
            return (len(word) > 2 or word.isdigit()) and "." not in word and word.lower() not in INSIDE
        return text[b] in ")]’'”»" and _after_closers(text, b)
    if INDIC.match(before):  # these scripts end sentences with a danda
        return False
    word = _word_before(text, a)
    low = word.lower()
    if not word:
        return not before.isspace()
    if low == "no":  # the answer, or a number's sign
        return _begins(text, a - 2) or not text[follows].isdigit() and _like_start(text, follows)
    if len(word) == 1 and word.isupper():
        return False
    if low in EITHER or low.rpartition(".")[2] in ("m", "μ") and _meridiem(text, a):
        return _like_start(text, follows)
    if low in INSIDE or low in ("b", "h", "d", "z", "ex", "ej", "à-d", "uu"):
        return False
    if len(word) == 1 and word.isalpha():
        return False
    if "." in word and all(len(x) <= 2 for x in word.split(".")) and not word[-1].isdigit():
        return False
    if word.isdigit() and len(word) <= 2:
        if DATE.match(text, follows):
            return False
        next_word = NEXT_WORD.match(text, follows)
        earlier = _word_before(text, _end_before(text, a - len(word)))
        if next_word and (next_word[0].lower() in MONTHS or earlier.lower() in BEFORE_ORDINAL and _german(text, follows)):
            return False
    return True


def _end_before(text: str, at: int) -> int:
    """The end of what isn't blank before a position."""
    while at > 0 and (text[at - 1].isspace() or text[at - 1] in "\u200b\u2060\ufeff"):
        at -= 1
    return at


def _german(text: str, at: int) -> bool:
    m = TEXT_WORD.match(text, at, at + 40)
    return bool(m) and m[0][0].isupper()


def _meridiem(text: str, a: int) -> bool:
    return bool(MERIDIEM.search(text[max(0, a - 6) : a]))


def _begins(text: str, at: int) -> bool:
    """Whether a position begins a text, a line or the words after a stop."""
    end = _end_before(text, at)
    return end == 0 or bool(LINES.search(text, end, at)) or text[end - 1] in STOPS + QUOTES


def _after_closers(text: str, b: int) -> bool:
    e = CLOSERS.match(text, b).end()
    m = FIRST.search(text, e, min(len(text), e + 200))
    return not m or m.start() > e and _like_start(text, m.start())


def _line_start(text: str, a: int) -> int:
    """Where the line that ends at a position begins; -1 if it is longer than LONG_LINE."""
    least = max(0, a - LONG_LINE)
    at = text.rfind("\n", least, a) + 1
    for m in OTHER_BREAK.finditer(text, at or least, a):
        at = m.end()
    return at if at or not least else -1


def _line_symbol(text: str, a: int, b: int, depth: int = 0) -> str | None:
    """What the blanks text[a:b], which hold line ends, do; None if they only wrap a line."""
    start = _line_start(text, a)
    whole = start >= 0
    start = max(start, a - LONG_LINE, 0)
    line = text[start:a].strip()
    listed = whole and _is_list(line)
    if listed and depth < 4 and POINTED.match(line):  # a number that a wrap put at the line's beginning makes no list
        first = FIRST.search(text, start, a).start()
        listed = not start or _line_symbol(text, _end_before(text, start), first, depth + 1) is not None
    n_breaks = len(LINES.findall(text, a, b))
    after = text[b : b + 200]
    after = after[: m.start()] if (m := LINES.search(after)) else after
    if not line or not after.strip():
        return "hard"
    ended = bool(ENDING.search(line)) and (line[-1] != "." or _is_stop(text, a - 1, a) or line[-2:-1] == ".")
    if not ended and line[-1] == "." and (BULLET.match(after) or NUMBERED.match(after)):  # an abbreviation that may end a sentence does so before a list
        ended = _word_before(text, a - 1).lower() in EITHER or _meridiem(text, a - 1)
    room = len(line) + 1 + len(after.split()[0])
    long = len(line) >= 40 and room >= WRAPPED
    unfinished = long and not ended and not listed and not HAS_THAI.search(line)
    if BULLET.match(after) and not (unfinished and n_breaks < 2) or NUMBERED.match(after) and not (unfinished and n_breaks < 2 and after[0].isalpha()):
        return "list"
    if POINTED.match(after) and (n_breaks > 1 or not unfinished) and len(after) < 60 and not ENDING.search(after.strip()):
        return "list"
    if n_breaks > 1:
        return "hard"
    if listed and len(line) < 60:
        return "break"
    if ended:
        return None  # the stop itself decides
    if ENDS_CJK.search(line) and BEGINS_CJK.match(after):
        return "break" if len(line) < 25 else None
    if HAS_THAI.search(line):
        return _thai(text, a, b) if ENDS_THAI.search(line) or not len(line) < 30 else "break"
    if line[-1] in "-\u00ad" and after[0].islower():
        return None
    if after[0].islower() and not LOW_NAME.match(after):
        return None if long or len(line) > 12 else "break"
    if not long or len(line) > 95 and not after[0].isdigit():
        return "break"
    return None


def _is_list(line: str) -> bool:
    return bool(BULLET.match(line) or NUMBERED.match(line) or POINTED.match(line) and len(line) < 60 and not ENDING.search(line))


def _thai(text: str, a: int, b: int) -> str | None:
    """Thai ends its sentences with a blank; one beside a number, a sign or an abbreviation ends none."""
    before = WORD_END.search(text[max(0, a - 60) : a])[0]
    after = WORD_START.match(text, b, b + 60)[0]
    if not ENDS_THAI.search(before) or THAI_SIGN.search(before) or not after or after[0] == "ๆ":
        return None
    if HAS_THAI.match(after):
        return None if "." in after or THAI_DIGIT.match(after) else "thai"
    if after[0].isdigit():  # a number belongs to the script after it
        beyond = BEYOND.match(text, b, b + 60)
        return "thai" if beyond and not HAS_THAI.match(beyond[1]) else None
    return "thai" if after[0].isalpha() and not after[0].islower() or after[0] in "¿¡" + QUOTES else None


#: What a chunk tells of closing marks to come: whether it holds a paragraph's end, the marks before that, and the first of those that close „.
Ahead = tuple[bool, int, str]
NOTHING_AHEAD: Ahead = (False, 0, "")


def beyond(own: Ahead, right: Ahead) -> Ahead:
    """What a chunk and those right of it tell together."""
    return own if own[0] else (right[0], own[1] | right[1], own[2] or right[2])


def _quote_symbol(text: str, a: int, marks: int, first: str) -> str:
    """The part that a quotation mark plays, given the closing marks after it in the paragraph."""
    c, size = text[a], len(text)
    before = text[a - 1] if a else " "
    opens = a + 1 < size and (c != '"' or (before.isspace() or before in "([（¿¡—–'’" or bool(OF_CJK.match(before))) and not text[a + 1].isspace())
    if opens:
        pairs = [i for i in OPENED_BY[c] if marks & CLOSING[PAIRS[i][1]]]
        if c == "»":  # opens only in the German manner, at a word's beginning
            if pairs and before.isspace() and not text[a + 1].isspace():
                return "swaplast" if _last(text, a) else "swap"
        elif pairs:
            return f"open{next((i for i in pairs if PAIRS[i][1] == first), pairs[0])}"
    return "close" if CLOSED_BY[c] else "text"


def with_quotes(text: str, tokens: list[tuple], right: Ahead = NOTHING_AHEAD) -> tuple[list[tuple[int, int, int]], Ahead]:
    """Tokens with the parts of their quotation marks, read from the right, and what they tell of closing marks."""
    out, (ended, marks, first) = [], right
    own = NOTHING_AHEAD
    for token in reversed(tokens):
        symbol, a, b = token
        if symbol == PARAGRAPH:
            ended, marks, first, own = True, 0, "", (True, 0, "")
        elif symbol != QUOTE:
            if symbol == STOP and b - a > 1:
                for c in reversed(text[a:b]):
                    if c in CLOSING:
                        marks, own = marks | CLOSING[c], (own[0], own[1] | CLOSING[c], c if c in "“”" else own[2])
                        first = c if c in "“”" else first
            out.append(token)
        else:
            c, s = text[a], _quote_symbol(text, a, marks, first)
            if s == "close":
                last = _last(text, a)
                out += [(SYMBOL[f"{'last' if last else 'close'}{i}"], a, b) for i in reversed(CLOSED_BY[c])]
            else:
                out.append((SYMBOL[s], a, b))
            if c in CLOSING:
                marks, own = marks | CLOSING[c], (own[0], own[1] | CLOSING[c], c if c in "“”" else own[2])
                first = c if c in "“”" else first
    return out[::-1], own


def symbols(text: str, begin: int = 0, end: int | None = None) -> list[tuple[int, int, int]]:
    """(symbol, start, stop) of the tokens that begin in text[begin:end], quotation marks and ends of paragraphs as such; the
    text around serves as context."""
    end = len(text) if end is None else end
    out = []
    thai = bool(HAS_THAI.search(text))
    add = lambda s, a, b: out.append((SYMBOL[s], a, b))
    if begin == 0 and (m := FIRST.search(text)) and _is_list(text[m.start() : m.start() + 60].split("\n")[0]):
        add("list", 0, 0)
    at = begin
    pattern = TOKEN_THAI if thai else TOKEN
    while at < end:
        m = pattern.match(text, at)
        if not m:
            at += 1
            continue
        at, kind = m.end(), m.lastgroup
        a, b = m.span()
        if kind == "text":
            c = text[a]
            start = a if c.isalnum() else m.start() if (m := FIRST.search(text, a, b)) else -1
            if start >= 0:
                out.append((0, start, b if text[b - 1].isalnum() else _end_before(text, b)))
        elif kind == "line":
            if s := _line_symbol(text, a, b):
                add(s, a, b)
            if len(LINES.findall(text, a, b)) > 1:
                out.append((PARAGRAPH, a, b))
        elif kind == "blank":
            if s := _thai(text, a, b):
                add(s, a, b)
        elif kind == "stop":
            if _is_stop(text, a, b):
                e = CLOSERS.match(text, b).end() if text[b : b + 1] not in QUOTES else b
                add("stop", a, e)
                at = max(b, e)
            else:
                add("text", a, b)
        else:
            out.append((QUOTE, a, b))
    return out


def _last(text: str, a: int) -> bool:
    """Whether a closing mark after a stop ends the sentence, if the quotation didn't begin it."""
    inside = _end_before(text, a)
    if not inside or text[inside - 1] not in STOPS or text[inside - 1] == ";":
        return False
    m = FIRST.search(text, a + 1, min(len(text), a + 200))
    if not m:
        return True
    if OF_CJK.match(text[m.start()]):
        return not PARTICLE.match(text[m.start() : m.start() + 2])
    return _like_start(text, m.start()) and text[m.start()] not in "(["


def read(text: str, tokens: list[tuple[int, int, int]], state: int = START) -> tuple[int, list[tuple[int, int]]]:
    """The state after tokens and the marks of units: (position, 1) for a start, (position, 0) for an end."""
    marks = []
    for symbol, a, b in tokens:
        out = _OUT[state][symbol]
        state = _NEXT[state][symbol]
        if out & ENDS_BEFORE:
            marks.append((_end_before(text, a), 0))
        if out & STARTS:
            marks.append((a, 1))
        if out & ENDS_AFTER:
            marks.append((b, 0))
    return state, marks


def function(tokens: list[tuple[int, int, int]]) -> np.ndarray:
    """A chunk as the state after it for each state before it."""
    state = np.arange(len(STATES))
    for symbol, _, _ in tokens:
        state = NEXT[state, symbol]
    return state


def scan(functions: np.ndarray) -> np.ndarray:
    """The state before each chunk, from the chunks' functions, by a prefix scan of compositions in log steps."""
    f, step = np.array(functions), 1
    while step < len(f):
        f[step:] = np.take_along_axis(f[step:], f[:-step], axis=1)
        step *= 2
    return np.concatenate([[START], f[:-1, START]])


def _units(text: str, marks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of marks that hold a letter or digit; a unit left open ends with the text."""
    out, start = [], None
    for at, begins in marks:
        if begins:
            start = at
        elif start is not None:
            out.append((start, at))
            start = None
    if start is not None:
        out.append((start, _end_before(text, len(text))))
    return [(a, b) for a, b in out if any(c.isalnum() for c in text[a:b])]


def units(text: str, chunk: int = CHUNK) -> list[tuple[int, int]]:
    """The sentence units of a text, read in chunks."""
    tokens, _ = with_quotes(text, symbols(text))
    if len(text) <= chunk:
        return _units(text, read(text, tokens)[1])
    parts: list[list] = [[] for _ in range(len(text) // chunk + 1)]
    for t in tokens:
        parts[t[1] // chunk].append(t)
    states = scan(np.array([function(p) for p in parts]))
    return _units(text, [m for p, state in zip(parts, states.tolist(), strict=True) for m in read(text, p, state)[1]])


UNIT = "doc_id long, start_char long, end_char long"


def _record(names: str, rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * len(names.split()))], names=names.split())


def sentence_units(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", row_chars: int = ROW) -> DataFrame:
    """One row per unit: `doc_id, start_char, end_char`, code points from 0, end exclusive.

    Texts of up to `row_chars` are read where they lie, in chunks of `CHUNK`. Longer ones are cut into rows that tasks read
    apart: first for the closing marks that they hold, then for their functions, of both of which a text has a few numbers per row, then,
    from the scanned states, for their units. Null and blank texts, and units without a letter or digit, give no rows.
    Repeated rows each give theirs.
    """
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")

    def whole(batches):
        for batch in batches:
            yield _record("doc_id start_char end_char", [(d, a, b) for d, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for a, b in units(t)])

    short = docs.where(F.length("text") <= row_chars).mapInArrow(whole, UNIT)
    by = ["doc_id", "digest"]
    # Repeated rows are read once and given as often as they come. A null id is an id.
    long = docs.where(F.length("text") > row_chars).withColumn("digest", F.md5("text")).withColumn("id", F.col("doc_id")).withColumn("doc_id", F.coalesce("doc_id", F.lit(0).cast("long")))
    long = long.groupBy(*by, F.col("id").isNull().alias("none")).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    by = [*by, "none"]
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.length("text").cast("long") - 1, F.lit(row_chars).cast("long")))
    chunks = long.select(*by, "text", begin.alias("begin")).select(
        *by, "begin", F.greatest(F.lit(0).cast("long"), F.col("begin") - CONTEXT).alias("base"),
        F.expr(f"substring(text, int(greatest(0, begin - {CONTEXT}) + 1), int(begin - greatest(0, begin - {CONTEXT}) + {row_chars + CONTEXT}))").alias("part"),
    ).repartition(*by, "begin")

    def tokens_of(part: str, begin: int, base: int) -> list[tuple[int, int, int]]:
        lead = begin - base
        return _whole_tokens(part, lead, min(len(part), lead + row_chars), first=base == 0 and begin == 0)

    keys = "doc_id long, digest string, none boolean, begin long"
    ahead = "struct<ended:boolean,marks:int,first:string>"

    def told(batches):
        kind = pa.struct([("ended", pa.bool_()), ("marks", pa.int32()), ("first", pa.string())])
        for batch in batches:
            begins, bases, parts = (c.to_pylist() for c in batch.columns[3:])
            own = [with_quotes(p, tokens_of(p, a, z))[1] for p, a, z in zip(parts, begins, bases, strict=True)]
            made = [{"ended": e, "marks": m, "first": f} for e, m, f in own]
            yield pa.record_batch([*batch.columns[:4], pa.array(made, kind)], names=[*by, "begin", "own"])

    def from_right(batches):
        for batch in batches:
            out = []
            for lists in batch.column(3).to_pylist():
                right, rows = NOTHING_AHEAD, []
                for x in reversed(lists):
                    rows.append({"begin": x["begin"], "ended": right[0], "marks": right[1], "first": right[2]})
                    right = beyond((x["own"]["ended"], x["own"]["marks"], x["own"]["first"]), right)
                out.append(rows)
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("ended", pa.bool_()), ("marks", pa.int32()), ("first", pa.string())]))
            yield pa.record_batch([*batch.columns[:3], pa.array(out, kind)], names=[*by, "rows"])

    tell = chunks.select(*by, "begin", "base", "part").mapInArrow(told, f"{keys}, own {ahead}")
    tell = tell.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("begin", "own"))).alias("lists"))
    right = tell.mapInArrow(from_right, "doc_id long, digest string, none boolean, rows array<struct<begin:long,ended:boolean,marks:int,first:string>>")
    right = right.select(*by, F.explode("rows").alias("r")).select(*by, "r.*")
    chunks = chunks.join(right, [*by, "begin"]).select(*by, "begin", "base", "part", "ended", "marks", "first")

    def resolved(columns) -> list[list[tuple[int, int, int]]]:
        return [with_quotes(p, tokens_of(p, a, z), (e, m, f))[0] for a, z, p, e, m, f in zip(*(c.to_pylist() for c in columns), strict=True)]

    def functions(batches):
        for batch in batches:
            f = [function(t).tolist() for t in resolved(batch.columns[3:9])]
            yield pa.record_batch([*batch.columns[:4], pa.array(f, pa.list_(pa.int32()))], names=[*by, "begin", "f"])

    lists = chunks.mapInArrow(functions, f"{keys}, f array<int>").groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("begin", "f"))).alias("fs"))

    def scanned(batches):
        for batch in batches:
            out = [[{"begin": x["begin"], "state": int(s)} for x, s in zip(fs, scan(np.array([x["f"] for x in fs])), strict=True)] for fs in batch.column(3).to_pylist()]
            yield pa.record_batch([*batch.columns[:3], pa.array(out, pa.list_(pa.struct([("begin", pa.int64()), ("state", pa.int64())])))], names=[*by, "rows"])

    states = lists.mapInArrow(scanned, "doc_id long, digest string, none boolean, rows array<struct<begin:long,state:long>>")
    states = states.select(*by, F.explode("rows").alias("r")).select(*by, "r.*")

    def marks(batches):
        for batch in batches:
            bases, parts, before = (batch.column(k).to_pylist() for k in (4, 5, 9))
            out = []
            for base, part, tokens, state in zip(bases, parts, resolved(batch.columns[3:9]), before, strict=True):
                out.append([{"at": base + at, "begins": kind} for at, kind in read(part, tokens, state)[1]])
            yield pa.record_batch([*batch.columns[:4], pa.array(out, pa.list_(pa.struct([("at", pa.int64()), ("begins", pa.int64())])))], names=[*by, "begin", "marks"])

    found = chunks.join(states, [*by, "begin"]).mapInArrow(marks, f"{keys}, marks array<struct<at:long,begins:long>>")
    # A start is followed by its end, in order of position; an end comes before a start at the same place. The text's end closes the last.
    spans = found.groupBy(*by).agg(F.sort_array(F.flatten(F.collect_list("marks"))).alias("marks")).join(long, by)

    def close(batches):
        for batch in batches:
            rows = [(d, a, b) for d, ms, t, n in zip(*(c.to_pylist() for c in batch.columns), strict=True) for a, b in _units(t, [(m["at"], m["begins"]) for m in ms]) for _ in range(n)]
            yield _record("doc_id start_char end_char", rows)

    return short.unionByName(spans.select(F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "marks", "text", "copies").mapInArrow(close, UNIT))


def _whole_tokens(part: str, begin: int, end: int, first: bool) -> list[tuple[int, int, int]]:
    """Tokens that begin in part[begin:end]. A token that a cut would divide is read from where it begins, by the chunk it
    begins in: reading starts at the last line end or blank before the cut, and earlier tokens are dropped."""
    start = begin
    while start > 0 and begin - start < CONTEXT // 2 and not (part[start].isspace() and not part[start - 1].isspace()):
        start -= 1
    if first:
        start = 0
    tokens = symbols(part, start, end) if start or first else symbols(" " + part, 1, end + 1)
    if not start and not first:
        tokens = [(s, a - 1, b - 1) for s, a, b in tokens]
    return [t for t in tokens if begin <= t[1] < end or first and t[1] == 0]
