"""Citations of scripture: books, canonical form, limits, and readers of free text in French and English."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# fixed values: the books in canonical order and the chapters of each
BOOKS_FR = "Genèse|Exode|Lévitique|Nombres|Deutéronome|Josué|Juges|Ruth|1 Samuel|2 Samuel|1 Rois|2 Rois|1 Chroniques|2 Chroniques|Esdras|Néhémie|Esther|Job|Psaumes|Proverbes|Ecclésiaste|Cantique des cantiques|Ésaïe|Jérémie|Lamentations|Ézéchiel|Daniel|Osée|Joël|Amos|Abdias|Jonas|Michée|Nahum|Habacuc|Sophonie|Aggée|Zacharie|Malachie|Matthieu|Marc|Luc|Jean|Actes|Romains|1 Corinthiens|2 Corinthiens|Galates|Éphésiens|Philippiens|Colossiens|1 Thessaloniciens|2 Thessaloniciens|1 Timothée|2 Timothée|Tite|Philémon|Hébreux|Jacques|1 Pierre|2 Pierre|1 Jean|2 Jean|3 Jean|Jude|Apocalypse".split("|")
BOOKS_EN = "Genesis|Exodus|Leviticus|Numbers|Deuteronomy|Joshua|Judges|Ruth|1 Samuel|2 Samuel|1 Kings|2 Kings|1 Chronicles|2 Chronicles|Ezra|Nehemiah|Esther|Job|Psalms|Proverbs|Ecclesiastes|Song of Solomon|Isaiah|Jeremiah|Lamentations|Ezekiel|Daniel|Hosea|Joel|Amos|Obadiah|Jonah|Micah|Nahum|Habakkuk|Zephaniah|Haggai|Zechariah|Malachi|Matthew|Mark|Luke|John|Acts|Romans|1 Corinthians|2 Corinthians|Galatians|Ephesians|Philippians|Colossians|1 Thessalonians|2 Thessalonians|1 Timothy|2 Timothy|Titus|Philemon|Hebrews|James|1 Peter|2 Peter|1 John|2 John|3 John|Jude|Revelation".split("|")
CHAPTERS_FR = [50, 40, 27, 36, 34, 24, 21, 4, 31, 24, 22, 25, 29, 36, 10, 13, 10, 42, 150, 31, 12, 8, 66, 52, 5, 48, 12, 14, 4, 9, 1, 4, 7, 3, 3, 3, 2, 14, 4, 28, 16, 24, 21, 28, 16, 16, 13, 6, 6, 4, 4, 5, 3, 6, 4, 3, 1, 13, 5, 5, 3, 5, 1, 1, 1, 22]
CHAPTERS_EN = [*CHAPTERS_FR[:28], 3, *CHAPTERS_FR[29:]]
MOST_VERSES = 176
# fixed values: short forms that are no beginnings of a name
SHORT_FR = {"mt": "Matthieu", "math": "Matthieu", "mc": "Marc", "lc": "Luc", "jn": "Jean", "gn": "Genèse", "dt": "Deutéronome", "is": "Ésaïe", "isaie": "Ésaïe", "ps": "Psaumes", "psaume": "Psaumes", "pr": "Proverbes", "qo": "Ecclésiaste", "ct": "Cantique des cantiques", "jr": "Jérémie", "ez": "Ézéchiel", "dn": "Daniel", "os": "Osée", "am": "Amos", "ac": "Actes", "rm": "Romains", "ro": "Romains", "ga": "Galates", "ep": "Éphésiens", "he": "Hébreux", "jc": "Jacques", "ap": "Apocalypse", "revelation": "Apocalypse"}
SHORT_EN = {"mt": "Matthew", "mk": "Mark", "lk": "Luke", "jn": "John", "gn": "Genesis", "ps": "Psalms", "psalm": "Psalms", "st john": "John", "saint john": "John", "st matthew": "Matthew", "saint matthew": "Matthew", "saint mark": "Mark", "saint luke": "Luke", "rev": "Revelation", "revelations": "Revelation", "song of songs": "Song of Solomon"}
_ORDINALS = {"1": ("1", "i", "1er", "1ere", "premiere", "premier", "first", "1st"), "2": ("2", "ii", "2e", "2eme", "deuxieme", "seconde", "second", "2nd"), "3": ("3", "iii", "3e", "3eme", "troisieme", "third", "3rd")}


def _key(s: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", plain.replace(".", "")).strip()


@functools.cache
def book_forms(lang: str) -> dict[str, str]:
    """Every written form of every book: whole names, beginnings that no other book shares, and short forms."""
    books, short = (BOOKS_FR, SHORT_FR) if lang == "fr" else (BOOKS_EN, SHORT_EN)
    stems: dict[str, set[str]] = {}
    for b in books:
        m = re.match(r"([123]) (.+)", b)
        name = _key(m[2] if m else b)
        for k in range(2, len(name) + 1):
            stems.setdefault(name[:k], set()).add("# " + (m[2] if m else "") if m else b)
    forms: dict[str, str] = {}
    for b in books:
        m = re.match(r"([123]) (.+)", b)
        name = _key(m[2] if m else b)
        own = "# " + m[2] if m else b
        # among books of one numbering, a beginning must belong to one stem; a whole name always counts
        cuts = {name[:k] for k in range(2 if m else 3, len(name) + 1) if {x for x in stems[name[:k]] if x.startswith("#") == bool(m)} == {own}} | {name}
        for c in cuts:
            if m:
                for o in _ORDINALS[m[1]]:
                    forms[f"{o} {c}"] = b
                    if len(o) == 1:
                        forms[f"{o}{c}"] = b
            else:
                forms.setdefault(c, b)
    forms.update({k: v for k, v in short.items() if k not in forms})
    return forms


#: What may be a book and a chapter: a numeral, one word (or a book of several), a number.
_MAYBE = re.compile(
    r"(?<!\w)(?P<num>(?:[123]\s*\.?\s*|(?:I{1,3}|1[eè]re?|[23](?:e|[eè]me)|premi[eè]re?|premier|deuxi[eè]me|seconde?|troisi[eè]me|first|second|third|1st|2nd|3rd)\.?\s+|(?:st|saint)\.?\s+))?"
    r"(?P<name>[^\W\d_]++(?:\s+(?:des\s+cantiques|of\s+(?:solomon|songs)))?)(?P<stop>\.?)\s*(?P<chapter>\d{1,3})(?!\d)",
    re.I,
)


def _book_at(m: re.Match, lang: str) -> tuple[str, int] | None:
    """The book that a candidate names and where it begins, with its numeral if that makes one."""
    if m["stop"] and lang == "en":
        return None
    forms = book_forms(lang)
    if m["num"]:
        book = forms.get(_key(m["num"] + " " + m["name"])) or forms.get(_key(m["num"].strip() + m["name"]))
        if book:
            return book, m.start("num")
    book = forms.get(_key(m["name"]))
    return (book, m.start("name")) if book else None


def _books(text: str, lang: str) -> Iterator[tuple[int, str, str, int, int]]:
    """``(start, written, book, chapter, end)`` of everything that reads as a book and a chapter."""
    at = 0
    while m := _MAYBE.search(text, at):
        hit = _book_at(m, lang)
        if hit:
            yield hit[1], text[hit[1] : m.end("name")], hit[0], m.start("chapter"), m.end()
            at = m.end()
        else:
            at = m.end("name")  # the number may begin the next book


@functools.cache
def limits(lang: str) -> dict[str, int]:
    return dict(zip(BOOKS_FR, CHAPTERS_FR)) if lang == "fr" else dict(zip(BOOKS_EN, CHAPTERS_EN))


def render(book: str, chapter: int, verses: list[tuple[int, int | None]]) -> str:
    """``Book c``, ``Book c:v``, ``Book c:v-w,x``."""
    spans = ",".join(str(a) if b is None else f"{a}-{b}" for a, b in verses)
    return f"{book} {chapter}:{spans}" if spans else f"{book} {chapter}"


def possible(book: str, chapter: int, verses: list[tuple[int, int | None]], lang: str = "fr") -> bool:
    return chapter <= limits(lang).get(book, 0) and all(v <= MOST_VERSES for s in verses for v in s if v is not None)


class _Reader:
    """Reads the numbers after a book, one piece at a time."""

    def __init__(self, text: str, at: int, lang: str):
        self.text, self.at, self.lang = text, at, lang
        self.word = "et" if lang == "fr" else "and"

    def take(self, pattern: str) -> re.Match | None:
        m = re.compile(pattern, re.I).match(self.text, self.at)
        if m:
            self.at = m.end()
        return m

    def starts_book(self, at: int) -> bool:
        """Whether a numbered book begins here: the 2 of "5:2 et 2 Timothée"."""
        m = _MAYBE.match(self.text, at)
        return bool(m and m["num"] and (h := _book_at(m, self.lang)) and h[1] == at) or bool(re.compile(r"[123]\s*\.?\s*[^\W\d_]{3}").match(self.text, at) and any(_key(self.text[at : at + n]) in book_forms(self.lang) for n in range(4, 22)))

    def span(self) -> tuple[int, int | None] | None:
        """A verse or a range that is no new chapter and verse."""
        start = self.at
        m = self.take(r"(\d{1,3})(?!\d)")
        if not m:
            return None
        a, b, after = int(m[1]), None, self.at
        r = self.take(r"\s*[-–—]\s*(\d{1,3})(?!\d)")
        if r and re.compile(r"\s*:\s*\d|\.\d").match(self.text, self.at):
            self.at = after
        elif r:
            b = int(r[1])
        if re.compile(r"[^\S\n]*:[^\S\n]*\d|\.\d").match(self.text, self.at):
            self.at = start
            return None
        return a, b


def citations(text: str, lang: str = "fr") -> Iterator[tuple[int, str, str]]:
    """``(index, text, ref)`` of every citation, in the order of the text, longer ones first where two begin together."""
    found = [*_written(text, lang), *(_spoken_fr(text) if lang == "fr" else _spoken_en(text))]
    images = [m.span() for m in re.finditer(r"\]\(<?data:[^)\n]*\)", text, re.I)]
    found = [f for f in found if not any(a <= f[0] < b for a, b in images)]
    yield from sorted(found, key=lambda f: (f[0], -len(f[1])))


def _written(text: str, lang: str) -> Iterator[tuple[int, str, str]]:
    top = limits(lang)
    for start, written, book, digits, end in _books(text, lang):
        if (lang == "en" and written[:1].islower()) or written == "nombre":
            continue
        r = _Reader(text, end, lang)
        chapter, verses, listed = int(text[digits:end]), [], False
        sep = r.take(r"(\s*[:,]\s*|\.(?=[1-9]))(?=\d)") if lang == "fr" else r.take(r"(\s*[:,]\s*)(?=\d)")
        if sep:
            begin = r.at
            first = None if r.starts_book(begin) else r.span()
            if first is None:
                r.at = end
            else:
                verses.append(first)
                while True:
                    back = r.at
                    link = r.take(rf"\s*[,;]\s*|\s+{r.word}\s+")
                    more = r.span() if link and not r.starts_book(r.at) else None
                    joined = bool(link) and link[0].strip().lower() == r.word
                    last = verses[-1][1] or verses[-1][0]
                    if more is None or (joined and more[0] <= last) or (joined and re.compile(r"[^\S\n]*,\d").match(text, r.at)):
                        r.at = back
                        break
                    listed |= joined
                    verses.append(more)
        if top[book] == 1 and not verses and chapter != 1:
            chapter, verses = 1, [(chapter, None)]
        # "26, 27 et 28": a comma, a blank and numbers that follow on are chapters
        if listed and sep and re.fullmatch(r",\s+", sep[1]) and all(b is None for _, b in verses) and verses[0][0] == chapter + 1:
            every = [chapter, *(a for a, _ in verses)]
            if every == sorted(set(every)) and every[-1] <= top[book]:
                yield start, text[start:end], f"{book} {chapter}"
                at = end
                for c in every[1:]:
                    at = text.index(str(c), at)
                    yield at, str(c), f"{book} {c}"
                    at += len(str(c))
                continue
        if not possible(book, chapter, verses, lang):
            continue
        ref = render(book, chapter, verses)
        yield start, text[start : r.at], ref if verses else _quoted(text, r.at, book, chapter, lang)
        while verses and lang == "fr" and (more := _next_chapter(r, book)):  # the same book goes on: "; 4:30", " et 8.14"
            yield more


def _next_chapter(r: _Reader, book: str) -> tuple[int, str, str] | None:
    """Another chapter and verse of the same book right after a citation; the reader stays where it was if there is none."""
    back = r.at
    if r.take(r"[^\S\n]*[;,][^\S\n]*|[^\S\n]+et[^\S\n]+"):
        begin, chapter = r.at, r.take(r"\d{1,3}(?!\d)")
        if chapter and r.take(r"\s*:\s*|\.(?=[1-9])"):
            verse = r.span()
            if verse and possible(book, int(chapter[0]), [verse]):
                return begin, r.text[begin : r.at], render(book, int(chapter[0]), [verse])
    r.at = back
    return None


def _quoted(text: str, at: int, book: str, chapter: int, lang: str) -> str:
    """A chapter and a colon before a block quote with bold verse numbers: the range that ascends from the first."""
    q = re.compile(r"[^\S\n]*:[^\S\n]*\n(?:[^\S\n]*\n)*((?:>.*\n?)+)").match(text, at)
    runs = [int(n) for n in re.findall(r"\*\*\s*(\d{1,3})\b", q[1].replace("\\*", "*"))] if q else []
    if not runs or not re.match(r">\s*\*\*", q[1].replace("\\*", "*")):
        return render(book, chapter, [])
    last = runs[0]
    for n in runs[1:]:
        if n <= last:
            break
        last = n
    verses = [(runs[0], last if last > runs[0] else None)]
    return render(book, chapter, verses if possible(book, chapter, verses, lang) else [])


class _Said:
    """A text as words, numbers and signs, and what they say of books and verses around "chapter"."""

    _PIECE = re.compile(r"\d+|[^\W\d_]+|[^\w\s]")

    def __init__(self, text: str, lang: str):
        self.text, self.lang = text, lang
        self.span = [m.span() for m in self._PIECE.finditer(text)]
        self.key = [_key(text[a:b]) if text[a:b] != "." else "." for a, b in self.span]
        self.names = {_key(n) for n in (BOOKS_FR if lang == "fr" else BOOKS_EN)}
        self.names |= {"psaume"} if lang == "fr" else {k for k in SHORT_EN if k.startswith("saint ")}

    def number(self, k: int) -> int | None:
        return int(self.key[k]) if 0 <= k < len(self.key) and self.key[k].isdigit() and len(self.key[k]) <= 3 else None

    def at(self, k: int) -> str:
        return self.key[k] if 0 <= k < len(self.key) else ""

    def _book(self, lo: int, hi: int) -> str | None:
        """The book whose full name, numeral included, are exactly the pieces ``lo..hi``."""
        raw = " ".join(self.key[lo:hi])
        book = book_forms(self.lang).get(raw)
        if not book or (raw not in self.names and re.sub(r"^\S+ ", "", _key(book)) != re.sub(r"^\S+ ", "", raw)):
            return None
        capital = self.text[self.span[lo][0]].isupper() or self.text[self.span[lo][0]].isdigit()
        return book if self.lang == "fr" or capital else None

    def book_before(self, end: int) -> tuple[str, int] | None:
        """The longest book name that ends just before a piece, and where it begins."""
        for n in (4, 3, 2, 1):
            if end - n >= 0 and (book := self._book(end - n, end)):
                return book, end - n
        return None

    def book_after(self, start: int) -> tuple[str, int] | None:
        for n in (4, 3, 2, 1):
            if start + n <= len(self.key) and (book := self._book(start, start + n)):
                if self.at(start + n) in ("-", "'", "’") and self.span[start + n][0] == self.span[start + n - 1][1]:
                    return None  # a longer name: Jean-Baptiste
                return book, start + n
        return None


_LINK_FR = frozenset("de du des la le l d aux selon livre epitre evangile ' ’".split())
_FILL_FR = frozenset(", ( a partir du de des depuis le la les au aux et".split())


def _verses_after_fr(p: _Said, k: int) -> tuple[list[tuple[int, int | None]], int]:
    """Verses said from a piece on, and the piece after them."""
    start, first = k, None
    if p.at(k) in (":", ".") and p.number(k + 1) is not None and (p.at(k) == ":" or p.span[k][1] == p.span[k + 1][0]):
        first, k = p.number(k + 1), k + 2
    else:
        while k - start < 5 and p.at(k) in _FILL_FR:
            k += 1
        if p.at(k) in ("verset", "versets"):
            first = 1 if p.at(k + 1) == "premier" else p.number(k + 1)
            k += 2
        elif p.at(k) == "premier" and p.at(k + 1) == "verset":
            first, k = 1, k + 2
    if first is None:
        return [], start
    last, more = None, None
    ahead = k + (2 if p.at(k) in ("au", "jusqu") and p.at(k + 1) == "verset" else 4 if p.at(k) == "jusqu" and p.at(k + 3) == "verset" else 1 if p.at(k) in ("-", "–", "—", "a") else 0)
    if ahead > k and p.number(ahead) is not None and not (p.at(ahead + 1) in (":", ".") and p.number(ahead + 2) is not None):
        last, k = p.number(ahead), ahead + 1
    if p.at(k) in ("et", ",") and p.number(k + 1) is not None and not p.book_after(k + 1) and not (p.at(k + 2) in (":", ".") and p.number(k + 3) is not None):
        more, k = p.number(k + 1), k + 2
    spans = [(first, last if last and last > first else None)]
    return spans + ([(more, None)] if more else []), k


def _verses_before_fr(p: _Said, k: int) -> tuple[list[tuple[int, int | None]], int]:
    """Verses said just before "du chapitre", and the piece where that begins."""
    if p.at(k - 1) != "du":
        return [], k
    v = next((j for j in range(k - 2, max(-1, k - 10), -1) if p.at(j) in ("verset", "versets")), None)
    if v is None:
        return [], k
    said = p.key[v + 1 : k - 1]
    if not said:
        if p.at(v - 1) == "premier":
            return [(1, None)], v - 1
        return ([(p.number(v - 2), None)], v - 2) if p.at(v - 1) in ("e", "eme") and p.number(v - 2) is not None else ([], k)
    if not all(x.isdigit() or x in ("a", "-", "–", "et") for x in said) or not said[0].isdigit():
        return [], k
    spans: list[tuple[int, int | None]] = [(int(said[0]), None)]
    for sign, n in zip(said[1::2], said[2::2]):
        spans = [*spans[:-1], (spans[-1][0], int(n))] if sign != "et" else [*spans, (int(n), None)]
    return spans, v


def _spoken_fr(text: str) -> Iterator[tuple[int, str, str]]:
    """"Luc chapitre 18 verset 9", "le verset 15 du chapitre 3 de la Genèse"."""
    if "chapitre" not in text.lower():
        return
    p = _Said(text, "fr")
    for k, word in enumerate(p.key):
        chapter = p.number(k + 1) if word == "chapitre" else None
        if chapter is None:
            continue
        verses, end = _verses_after_fr(p, k + 2)
        back = k
        while p.at(back - 1) in ("au", "le", ","):
            back -= 1
        hit = p.book_before(back)
        begin = hit[1] if hit else k
        if not hit:
            ahead = end
            while p.at(ahead) in _LINK_FR and ahead - end < 6:
                ahead += 1
            hit = p.book_after(ahead) if ahead > end else None
            if not hit:
                continue
            end = hit[1]
            before, start = _verses_before_fr(p, k)
            if before:
                verses, begin = before, start
                while p.at(begin - 1) in ("le", "au", "du", "les", "aux"):
                    begin -= 1
            elif not verses:
                verses, end = _verses_after_fr(p, end)
        lo, hi = p.span[begin][0], p.span[end - 1][1]
        if possible(hit[0], chapter, verses):
            yield lo, text[lo:hi], render(hit[0], chapter, verses) if verses else _quoted(text, hi, hit[0], chapter, "fr")


_SUFFIX_EN = ("st", "nd", "rd", "th")


def _spoken_en(text: str) -> Iterator[tuple[int, str, str]]:
    """"Saint John the 4th chapter, the 23rd verse", "the 20th chapter of Numbers"."""
    if "chapter" not in text.lower():
        return
    p = _Said(text, "en")
    for k, word in enumerate(p.key):
        if word != "chapter" or p.at(k - 1) not in _SUFFIX_EN or p.number(k - 2) is None:
            continue
        chapter, begin, end = p.number(k - 2), k - 2, k + 1
        back = begin
        while p.at(back - 1) in ("the", "and", ","):
            back -= 1
        if p.at(back - 1) == "gospel":
            back -= 3  # John's Gospel
        hit = p.book_before(back)
        if hit:
            begin = hit[1]
        elif p.at(end) == "of":
            hit = p.book_after(end + 1)
            again = next((j for j in range(end + 2, end + 7) if p.at(j) == "of"), None)
            if again and not hit:  # a name cut off and said again
                hit = p.book_after(again + 1)
            if hit:
                end = hit[1]
                begin -= p.at(begin - 1) == "the"
        if not hit:
            continue
        numbers, j = [], end
        while j - end < 24 and (p.at(j) in ("the", "and", ",", "verse", "verses", *_SUFFIX_EN) or p.number(j) is not None):
            if p.number(j) is not None and p.at(j + 1) in _SUFFIX_EN:
                numbers.append(j)
            j += 1
        said = [q for q in range(end, j) if p.at(q) in ("verse", "verses")]
        spans = [(p.number(q), None) for q in numbers if said and q < said[-1]]
        if spans:
            end = said[-1] + 1
        lo, hi = p.span[begin][0], p.span[end - 1][1]
        if possible(hit[0], chapter, spans, "en"):
            yield lo, text[lo:hi], render(hit[0], chapter, spans)


CITATION = ArrayType(StructType([StructField("index", IntegerType()), StructField("text", StringType()), StructField("ref", StringType())]))


def extract(text: Column, lang: str = "fr") -> Column:
    """Array of the citations of a text; empty for null."""
    kind = pa.list_(pa.struct([("index", pa.int32()), ("text", pa.string()), ("ref", pa.string())]))

    @F.arrow_udf(CITATION)
    def run(b: pa.Array) -> pa.Array:
        return pa.array([[{"index": i, "text": t, "ref": r} for i, t, r in citations(x or "", lang)] for x in b.to_pylist()], kind)

    return run(text)


def parse_graph(ref: Column) -> dict[str, Column]:
    """Book, chapter, first and last verse of a canonical reference; of a list only the first span."""
    got = lambda k: F.nullif(F.regexp_extract(ref, r"^(.+?) (\d+)(?::(\d+)(?:-(\d+))?)?", k), F.lit(""))
    return {"book": got(1), "chapter": got(2).cast("int"), "verse_start": got(3).cast("int"), "verse_end": got(4).cast("int")}


def verses_of(ref: Column) -> Column:
    """All verses of a canonical reference, ranges and lists spelled out; empty for a whole chapter."""
    spans = F.filter(F.split(F.regexp_extract(ref, r":(.+)$", 1), ","), lambda s: s != "")
    one = lambda s: F.sequence(F.split(s, "-")[0].cast("int"), F.greatest(F.split(s, "-")[0].cast("int"), F.element_at(F.split(s, "-"), -1).cast("int")))
    return F.flatten(F.transform(spans, one))


def book_number(book: Column) -> Column:
    """Place of a book in the canon from 1, by its French or English name; null for others."""
    pairs = [x for k, names in enumerate(zip(BOOKS_FR, BOOKS_EN), 1) for n in dict.fromkeys(names) for x in (F.lit(n), F.lit(k))]
    return F.element_at(F.create_map(*pairs), book)


def url(ref: Column) -> Column:
    """Path of a reference: ``/bible/<book>/<chapter>/#v<first verse>``."""
    from .norm import slug

    p = parse_graph(ref)
    return F.concat(F.lit("/bible/"), slug(p["book"]), F.lit("/"), p["chapter"].cast("string"), F.lit("/"), F.coalesce(F.concat(F.lit("#v"), p["verse_start"].cast("string")), F.lit("")))
