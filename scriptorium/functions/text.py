"""Text transforms: Column expressions where SQL can say it, Arrow functions where state runs along the text."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from . import norm

# fixed values: French month names
MONTHS_FR = "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split()
_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&rsquo;", "’"), ("&amp;", "&")]


def html_to_text(c: Column) -> Column:
    """Plain text of HTML: block tags as blanks, other tags removed, common entities decoded."""
    t = F.regexp_replace(c, r"(?is)<(?:script|style)\b.*?</(?:script|style)>", " ")
    t = F.regexp_replace(t, r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|blockquote|section|article)\b[^>]*>", " ")
    t = F.regexp_replace(t, r"<[^>]+>", "")
    for a, b in _ENTITIES:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


class _Markdown(HTMLParser):
    """Markdown of a document: headings, emphasis, links, lists, quotes, tables; images and hidden blocks dropped."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.lists: list[list] = []
        self.hidden = 0
        self.href: list[str | None] = []
        self.cells: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if self.hidden or tag in ("script", "style", "head") or "hidden" in a or "display:none" in (a.get("style") or "").replace(" ", ""):
            self.hidden += tag not in ("br", "img", "hr", "input", "meta", "link")
            return
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("p", "div", "section", "article"):
            self.out.append("\n\n")
        elif tag == "br":
            self.out.append("  \n")
        elif tag in ("strong", "b"):
            self.out.append("**")
        elif tag in ("em", "i"):
            self.out.append("*")
        elif tag == "a":
            self.href.append(a.get("href"))
            self.out.append("[" if a.get("href") else "")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.out.append("\n" if len(self.lists) > 1 else "\n\n")
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            self.out.append("\n" + "  " * (len(self.lists) - 1) + (f"{kind[1]}. " if kind[0] == "ol" else "- "))
        elif tag == "blockquote":
            self.out.append("\n\n> ")
        elif tag == "tr":
            self.cells = []
        elif tag in ("td", "th"):
            self.out.append("\0")
        elif tag == "dt":
            self.out.append("\n\n**")
        elif tag == "dd":
            self.out.append("\n: ")

    def handle_endtag(self, tag):
        if self.hidden:
            self.hidden -= 1
            return
        if tag in ("strong", "b"):
            self.out.append("**")
        elif tag in ("em", "i"):
            self.out.append("*")
        elif tag == "dt":
            self.out.append("**")
        elif tag == "a" and self.href:
            to = self.href.pop()
            self.out.append(f"]({to})" if to else "")
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
            self.out.append("\n")
        elif tag in ("td", "th") and self.cells is not None:
            at = max(k for k, x in enumerate(self.out) if x == "\0")
            self.cells.append(" ".join("".join(self.out[at + 1 :]).split()))
            del self.out[at:]
        elif tag == "tr" and self.cells is not None:
            self.out.append("\n| " + " | ".join(self.cells) + " |")
            self.cells = None

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(re.sub(r"\s+", " ", data))


def markdown_of(html: str) -> str:
    p = _Markdown()
    p.feed(html)
    p.close()
    t = "".join(p.out).replace("\0", "")
    t = re.sub(r"(\*{1,2})(\s*)([^*]+?)(\s*)\1", r"\2\1\3\1\4", t)  # no blank inside the edge of emphasis
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"(?<! )[ \t]\n", "\n", t)).strip()


@F.arrow_udf(StringType())
def html_to_md(b: pa.Array) -> pa.Array:
    return pa.array([None if x is None else markdown_of(x) for x in b.to_pylist()], pa.string())


def clean_lines(c: Column) -> Column:
    """Lines stripped, without page numbers and "x sur n" lines; at most one blank line together."""
    lines = F.transform(F.split(c, "\n"), lambda x: F.trim(x))
    kept = F.filter(lines, lambda x: ~x.rlike(r"^(?:(?:page )?\d{1,4}(?: ?(?:/|sur) ?\d{1,4})?|[-–—•\[] ?\d{1,4} ?[-–—•\]])$"))
    return F.trim(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"))


def dot_leaders(c: Column) -> Column:
    """Runs of eight dots or more as an ellipsis."""
    return F.regexp_replace(c, r"\.{8,}", "… ")


def chunks(text: str, most: int = 45_000) -> list[str]:
    """Pieces of at most ``most`` characters, cut at the last blank line past the middle, else a sentence, else hard."""
    out, at = [], 0
    while len(text) - at > most:
        cut = text.rfind("\n\n", at + most // 2, at + most)
        skip = 2
        if cut < 0:
            cut = text.rfind(". ", at + most // 2, at + most)
            cut, skip = (cut + 1, 1) if cut >= 0 else (at + most, 0)
        out.append(text[at:cut])
        at = cut + skip
    return [*out, text[at:]] if text[at:] or not out else out


def word_chunks(text: str, most: int = 3_500) -> list[str]:
    """Pieces of at most ``most`` words, each but the last cut after the end of a sentence if it has one."""
    out, now, n = [], "", 0
    for s in re.findall(r"[\s\S]+?(?:[.!?…]+[»”\")]*(?=\s)\s*|$)", text):
        k = len(s.split())
        if n and n + k > most:
            out.append(now.strip())
            now, n = "", 0
        now, n = now + s, n + k
    return [*out, now.strip()] if now.strip() or not out else out


def _array_udf(f, *args):
    @F.arrow_udf(ArrayType(StringType()))
    def run(b: pa.Array) -> pa.Array:
        return pa.array([[] if not x else f(x, *args) for x in b.to_pylist()], pa.list_(pa.string()))

    return run


def chunk_paragraph(c: Column, most: int = 45_000) -> Column:
    return _array_udf(chunks, most)(c)


def chunk_words(c: Column, most: int = 3_500) -> Column:
    return _array_udf(word_chunks, most)(c)


def excerpt_chars(c: Column, most: int = 200) -> Column:
    """The first paragraph with words, unmarked, at most ``most`` characters, cut at a word with an ellipsis."""
    paragraphs = F.filter(F.split(c, r"\n\s*\n"), lambda p: ~p.rlike(r"^\s*(?:#|!\[|---|\|)") & (F.length(F.trim(p)) > 0))
    p = F.trim(F.regexp_replace(norm.unmark(F.get(paragraphs, F.lit(0))), r"\s+", " "))
    short = F.concat(F.regexp_replace(F.substring(p, 1, most), r"\s+\S*$", ""), F.lit("…"))
    return F.when(F.length(p) <= most, p).otherwise(short)


def excerpt_of(text: str, most: int = 200, least: int = 120, start: str | None = None) -> str:
    """Whole blocks up to ``most`` words; if that is under ``least``, the next block up to a sentence end."""
    at = text.find(start) if start else 0
    blocks = [b.strip() for b in re.split(r"\n\s*\n", text[max(at, 0) :]) if b.strip() and not b.lstrip().startswith("#")]
    out, n = [], 0
    for b in blocks:
        k = len(b.split())
        if n + k <= most:
            out.append(b)
            n += k
            continue
        if n < least:
            now = ""
            for s in re.findall(r"[\s\S]+?(?:[.!?…]+[»”\")]*(?=\s|$)|$)", b):
                if not s or n + len((now + s).split()) > most:
                    break
                now += s
            out.append(now.strip() or " ".join(b.split()[: most - n]) + "…")
        break
    return "\n\n".join(x for x in out if x)


def excerpt_words(c: Column, most: int = 200, least: int = 120) -> Column:
    @F.arrow_udf(StringType())
    def run(b: pa.Array) -> pa.Array:
        return pa.array([None if x is None else excerpt_of(x, most, least) for x in b.to_pylist()], pa.string())

    return run(c)


def reading_minutes(c: Column, per_minute: int = 200) -> Column:
    """At least one; words over words a minute, halves rounded up."""
    n = F.size(F.split(F.coalesce(c, F.lit("")), r"\s+"))
    return F.greatest(F.lit(1), F.floor(n / per_minute + 0.5).cast("int"))


def french_spacing(c: Column) -> Column:
    """A narrow no-break space before ``: ; ? !`` and inside guillemets; none in addresses, times and references."""
    t = F.regexp_replace(c, "(?<![\\d/\\s\\u202F\\u00A0])[ \\u00A0]?([;?!])(?![\\w/])", " $1")
    t = F.regexp_replace(t, "(?<=\\D)[ \\u00A0]([:;?!])", " $1")
    t = F.regexp_replace(t, "(?<=\\p{L})(:)(?=\\s|$)", " $1")
    t = F.regexp_replace(t, "«[ \\u00A0\\u202F]*", "« ")
    t = F.regexp_replace(t, "[ \\u00A0\\u202F]*»", " »")
    return F.regexp_replace(t, "(\\d)[ \\u00A0\\u202F]+:[ \\u00A0\\u202F]*(?=\\d)", "$1:")


def sentence_case(c: Column) -> Column:
    """Names of months and parts of the day in lower case, but for the first word."""
    low = "|".join(m.capitalize() for m in [*MONTHS_FR, "matin", "soir", "après-midi", "partie"])
    first = F.regexp_extract(c, r"^(\s*\S+)", 1)
    rest = F.substring(c, F.length(first) + 1, F.length(c))
    return F.concat(first, F.array_join(F.transform(F.split(rest, "(?<=\\s)|(?=\\s)"), lambda w: F.when(w.rlike(f"^(?:{low})$"), F.lower(w)).otherwise(w)), ""))


def heading_guard(said: Column, proposed: Column) -> Column:
    """Whether a proposed heading has the letters of the one in the text, whatever case, accents and ligatures."""
    letters = lambda x: F.regexp_replace(F.regexp_replace(norm.unaccent(F.lower(x)), "œ", "oe"), "[^a-z0-9]", "")
    return letters(said) == letters(proposed)


def heading_candidates(c: Column) -> Column:
    """One-line paragraphs in capitals or bold, with four letters or more and fifteen words at most."""
    p = F.transform(F.split(c, r"\n\s*\n"), lambda x: F.trim(x))
    capitals = lambda x: x.rlike(r"\p{Lu}.*\p{Lu}.*\p{Lu}.*\p{Lu}") & ~x.rlike(r"\p{Ll}")
    return F.filter(p, lambda x: ~F.contains(x, F.lit("\n")) & (F.size(F.split(x, r"\s+")) <= 15) & (capitals(x) | x.rlike(r"^\*\*[^*]*\p{L}{2}[^*]*\p{L}{2}[^*]*\*\*$")))


def blockquote(verses: Column, ref: Column) -> Column:
    """``> **n** text … (ref)`` of an array of structs ``v, text``, verses in order."""
    lines = F.transform(F.array_sort(verses), lambda s: F.concat(F.lit("**"), s["v"].cast("string"), F.lit("** "), s["text"]))
    return F.concat(F.lit("> "), F.array_join(lines, " "), F.lit(" ("), ref, F.lit(")"))


def date_fr(c: Column) -> Column:
    """"12 octobre 2012" of a date of any precision; other strings as they are."""
    y, m, d = (F.regexp_extract(c, r"^(\d{4})(?:-(\d{2}))?(?:-(\d{2}))?", k) for k in (1, 2, 3))
    name = F.get(F.array(*[F.lit(x) for x in MONTHS_FR]), F.when(m.between("01", "12"), m.cast("int") - 1))
    day = F.when(d != "", F.concat(d.cast("int").cast("string"), F.lit(" "))).otherwise("")
    return F.when(m.between("01", "12"), F.concat(day, name, F.lit(" "), y)).otherwise(c)


def opening(c: Column, least: int = 20) -> Column:
    """The lines before the first paragraph of ``least`` words that do not come again later."""
    lines = F.filter(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    long = F.transform(lines, lambda x: F.size(F.split(x, r"\s+")) >= least)
    at = F.array_position(long, F.lit(True)).cast("int")
    head = F.when(at > 0, F.slice(lines, 1, F.greatest(at - 1, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    rest = F.when(at > 0, F.slice(lines, at, F.size(lines))).otherwise(F.array().cast("array<string>"))
    return F.array_except(head, rest)


def relink(c: Column, host: str) -> Column:
    """Links to one's own host made relative to the root."""
    return F.regexp_replace(c, rf"https?://(?:www\.)?{re.escape(host)}(/[^\s)\"']*)", "$1")


def file_cards(c: Column) -> Column:
    """Multi-line file embeds (``[\\n\\ntitle\\n\\n](url)``) as one link."""
    return F.regexp_replace(c, r"\[\s*\n+\s*([^\]\n]+?)\s*(?:\n[^\]]*)?\]\(([^)\s]+)\)", "[$1]($2)")


def links(c: Column) -> Column:
    """Targets of all markdown and HTML links."""
    return F.array_union(F.regexp_extract_all(c, F.lit(r"\]\(([^)\s]+)\)"), 1), F.regexp_extract_all(c, F.lit(r"href=\"([^\"]+)\""), 1))


def part_number(title: Column) -> Column:
    """The part that a title says it is: "(3)", "partie 5", "deuxième partie", a final "-2"."""
    said = ["première", "deuxième", "troisième", "quatrième", "cinquième", "sixième"]
    spelled = [F.when(F.lower(title).contains(f"{w} partie"), k) for k, w in enumerate(said, 1)]
    found = [F.nullif(F.regexp_extract(title, p, 1), F.lit("")).cast("int") for p in (r"\((\d{1,2})\)\s*$", r"(?i)\bpart(?:ie)?\s+(\d{1,2})\b", r"-(\d{1,2})$")]
    return F.coalesce(found[0], found[1], *spelled, found[2])


def date_from_id(id: Column) -> Column:
    """``YY-MMDD`` at the start of an id as a partial date; a month or day 00 is unknown."""
    y, m, d = (F.regexp_extract(id, r"^(\d{2})-(\d{2})(\d{2})", k) for k in (1, 2, 3))
    full = F.concat(F.lit("19"), y)
    return F.when(y == "", F.lit(None)).when(~m.between("01", "12"), full).when(~d.between("01", "31"), F.concat_ws("-", full, m)).otherwise(F.concat_ws("-", full, m, d))


def date_from_name(name: Column) -> Column:
    """A partial date in a file name: month name and year, ``MM_YYYY``, or any year."""
    low = norm.unaccent(F.lower(name))
    by_name = [F.when(F.regexp_extract(low, rf"{m[:4]}[a-z]*[_\- ]+(\d{{4}})", 1) != "", F.concat(F.regexp_extract(low, rf"{m[:4]}[a-z]*[_\- ]+(\d{{4}})", 1), F.lit(f"-{k:02d}"))) for k, m in enumerate(["janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre"], 1)]
    number = F.when(low.rlike(r"(?<!\d)(?:0[1-9]|1[0-2])_(?:19|20)\d{2}(?!\d)"), F.concat(F.regexp_extract(low, r"(?<!\d)(0[1-9]|1[0-2])_((?:19|20)\d{2})(?!\d)", 2), F.lit("-"), F.regexp_extract(low, r"(?<!\d)(0[1-9]|1[0-2])_((?:19|20)\d{2})(?!\d)", 1)))
    return F.coalesce(*by_name, number, F.nullif(F.regexp_extract(low, r"(?<!\d)((?:19|20)\d{2})(?!\d)", 1), F.lit("")))


def title_page(c: Column) -> dict[str, Column]:
    """Day, part of the day and a title in parentheses from the first 25 lines of a text."""
    top = F.array_join(F.slice(F.split(c, "\n"), 1, 25), "\n")
    months = "|".join(MONTHS_FR)
    day = rf"(?i)\b(\d{{1,2}})(?:er)? ({months}) (\d{{4}})\b"
    d, m, y = (F.regexp_extract(top, day, k) for k in (1, 2, 3))
    number = F.array_position(F.array(*[F.lit(x) for x in MONTHS_FR]), F.lower(m))
    return {"day": F.when(y != "", F.concat_ws("-", y, F.lpad(number.cast("string"), 2, "0"), F.lpad(d, 2, "0"))), "time": F.nullif(F.lower(F.regexp_extract(top, r"(?i)\b(matin|après-midi|soir)\b", 1)), F.lit("")), "original_title": F.nullif(F.regexp_extract(top, r"\(([A-Z][A-Za-z' ,]{3,60})\)", 1), F.lit(""))}


def printed(c: Column, value: Column) -> Column:
    """Whether a value stands on a line of 45 characters or fewer, whatever case and accents."""
    return F.exists(F.split(norm.fold_print(c), "\n"), lambda x: (F.length(x) <= 45) & F.contains(x, norm.fold_print(value)))


def signature(c: Column, name: Column) -> Column:
    """confirmed if the name stands in the first or last forty lines or on a short line; contradicted if another
    name is signed there; else not printed."""
    lines = F.split(norm.fold_print(c), "\n")
    edge = F.concat(F.slice(lines, 1, 40), F.slice(F.reverse(lines), 1, 40), F.filter(lines, lambda x: F.length(x) <= 45))
    own = norm.fold_print(name)
    other = F.exists(edge, lambda x: x.rlike(r"^(?:fr\.?|frere|pasteur|signe|par) [a-z'-]+ [a-z'-]+$"))
    return F.when(F.exists(edge, lambda x: F.contains(x, own)), "confirmed").when(other, "contradicted").otherwise("not printed")


def metadata(c: Column) -> dict[str, Column]:
    """Title, date, place and speaker from the first 20 lines of a text, by labelled lines first."""
    lines = F.slice(F.filter(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), lambda x: x != ""), 1, 20)
    top = F.array_join(lines, "\n")
    label = lambda p: F.nullif(F.trim(F.regexp_extract(top, rf"(?im)^(?:{p})\s*:\s*(.+)$", 1)), F.lit(""))
    heading = F.nullif(F.regexp_extract(top, r"(?m)^#+\s+(.+)$", 1), F.lit(""))
    capitals = F.get(F.filter(lines, lambda x: x.rlike(r"\p{Lu}{2}") & ~x.rlike(r"\p{Ll}") & (F.length(x) > 5)), F.lit(0))
    page = title_page(c)
    return {"title": F.coalesce(label("titre|sujet|title"), heading, capitals), "date": F.coalesce(label("date"), page["day"]), "location": label("lieu|place|location"), "preacher": F.regexp_replace(label("pr[ée]dicateur|orateur|par|preacher"), r"(?i)\s+(?:le|du|de la|à)$", "")}
