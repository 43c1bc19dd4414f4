"""One consistent form for text that looks alike (problem 4).

Method.  A quick-check character class tells, inside the JVM, the values that are certainly stable; only the others
reach Python.  There the unstable characters are found with their boundary context (the run of letters, digits, marks
and unstable characters around them), each such segment is normalized by itself, and the canonical segments are
spliced into the text, which is otherwise not touched.

Canonical form of a segment: invisible characters go; letters, digits and ligatures of compatibility forms become
plain ones; marks are composed with their letters; every white space but the line feed becomes U+0020; in a word
that has Latin letters too, letters of other scripts (and look-alike Latin ones) become the Latin letter they look
like.  Words wholly in one other script keep their letters; quotation marks, dashes, ellipses and the letters oe/ae
are never touched.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Characters that no rule changes, alone or beside any other one of them: the inside of a character class.
STABLE = "\\n\\x20-\\x7E\\u00A1-\\u00A7\\u00A9\\u00AB\\u00AC\\u00AE\\u00B0\\u00B1\\u00B6\\u00B7\\u00BB\\u00BF-\\u0130\\u0134-\\u013E\\u0141-\\u0148\\u014A-\\u017E\\u2010\\u2012-\\u2016\\u2018-\\u2022\\u2026\\u2030\\u2039\\u203A\\u20AC\\u2122"

# fixed values: letters of other scripts, and of the Latin script, beside the plain letters that they look like
_LOOKS = {
    "Cyrillic": ("АВЕЅІЈКМНОРСТУХҮЗЬаеѕіјӏорсухԁҽһԛԝѵүгпԍ", "ABESIJKMHOPCTYXY3baesijlopcyxdehqwvyrng"),
    "Greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹαινορυγκηχϳϲ", "ABEZHIKMNOPTYXCaivopuyknxjc"),
    "Armenian": ("ՍՏՕԼոսցօհզքԱ", "USOLnugohqpU"),
    "Latin": ("ɑɡıȷʏɩᴀʙᴄᴅᴇɢʜᴊᴋʟᴍɴᴏᴘʀᴛᴜᴠᴡᴢꜱ", "agijyiabcdeghjklmnoprtuvwzs"),
    "Cherokee": ("ᎪᎡᎢᎫᎬᎳᎷᎻᏀᏃᏆᏎᏒᏚᏞᏟᏢᏦᏴ", "ARTJEWMHGZISRSLCPKB"),
}
LOOK_ALIKE = {a: b for own, plain in _LOOKS.values() for a, b in zip(own, plain)}
_OWN_LATIN = frozenset(_LOOKS["Latin"][0])
# fixed values: letters of alphabets that have a dotless i, and vowels that take it in their words
_DOTLESS, _BACK, _FRONT = frozenset("ıİğşĞŞ"), frozenset("aıouAIOU"), frozenset("eiöüEİÖÜ")
#: Joiners that the scripts of these blocks, and joined pictures, need: there they are no disguise.
_JOINERS = "\u200c\u200d"
_JOINING = ((0x600, 0x780), (0x7C0, 0x860), (0x8A0, 0x900), (0x900, 0xE00), (0x1000, 0x10A0), (0x1780, 0x1880), (0xFB50, 0xFE00), (0xFE70, 0xFEFF), (0x2600, 0x27C0), (0x1F300, 0x1FB00), (0xFE00, 0xFE10))
_INVISIBLE = frozenset([0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)])

_unstable = re.compile(f"[^{STABLE}]")
#: What our own rules may change beside compatibility forms: look-alikes, invisible characters and white space.
_beyond = re.compile(f"[{''.join(LOOK_ALIKE)}\\x00-\\x09\\x0b-\\x1f\\x7f-\\xa0\\xad\\u0300-\\u036f\\u0600-\\u0605\\u061c\\u06dd\\u070f\\u115f\\u1160\\u1680\\u17b4\\u17b5\\u180b-\\u180f\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u206f\\u2400-\\u24ff\\u3000\\u3164\\ufe00-\\ufe0f\\ufeff\\uffa0\\ufff0-\\uffff\U00010000-\U0010ffff]")
#: Powers and units as they are written behind a letter: no disguise.
_POWERS = frozenset("²³¹")
_segment = re.compile(rf"(?:[^\W_]|[^{STABLE}])+")
_WORD_OWN = re.compile(r"(?:[^\W\d_]|[\0̀-ͯ])+")
_word = re.compile(r"(?:[^\W\d_]|[̀-ͯ])+")


def _script(ch: str) -> str:
    return unicodedata.name(ch, "?").split(" ")[0]


def _plain(ch: str) -> str:
    """One character without compatibility form, invisible characters and odd white space."""
    kind = unicodedata.category(ch)
    if kind in ("Cf", "Cc") or ord(ch) in _INVISIBLE:
        return " " if ch in "\t\r\v\f\x85\x1c\x1d\x1e\x1f" else ch if ch == "\n" else ""
    if kind in ("Zs", "Zl", "Zp"):
        return " "
    if ch in LOOK_ALIKE:
        return ch
    if kind[0] in "LN" or "WITH" not in (name := unicodedata.name(ch, "")) and ("CIRCLED" in name or "SQUARED" in name or "PARENTHESIZED" in name):
        form = unicodedata.normalize("NFKC", ch)
        if form != ch and kind == "No" and "⁄" in form:  # a fraction is no single digit
            return ch
        if form != ch and kind[0] not in "LN":
            form = form.strip("()")
        return form
    return ch


def _joined(segment: str, k: int) -> bool:
    """Whether the joiner at ``k`` stands beside a letter or picture that needs it."""
    near = segment[max(k - 2, 0) : k] + segment[k + 1 : k + 2]
    return any(lo <= ord(c) < hi for c in near for lo, hi in _JOINING)


def _own_dotless(word: str) -> bool:
    """Whether a dotless i is the word's own: beside other letters of such alphabets, or never with an i or front vowel.

    In those languages the vowels of a word are all back (``a ı o u``) or all front (``e i ö ü``), and a word has the
    letter again and again; a single one among other languages' vowels is a disguise.
    """
    if any(c in _DOTLESS and c != "ı" for c in word):
        return True
    vowels = [c for c in word if c in _BACK or c in _FRONT]
    return word.count("ı") > 1 and not any(c in _FRONT for c in vowels)


def _own_letters(m: re.Match) -> str:
    word = m[0]
    odd = [c for c in word if c in LOOK_ALIKE]
    if not odd:
        return word
    if "ı" in word and _own_dotless(word):
        word = word.replace("ı", "\0")
        return _WORD_OWN.sub(_own_letters, word).replace("\0", "ı") if len(odd) > word.count("\0") else word.replace("\0", "ı")
    scripts = {_script(c) for c in word if c.isalpha() and c not in _OWN_LATIN}
    if "LATIN" not in scripts and (len(scripts) == 1 or not all(c in LOOK_ALIKE for c in word)):
        return word
    return "".join(LOOK_ALIKE.get(c, c) for c in word)


def _normal(m: re.Match) -> str:
    segment = m[0]
    if not _unstable.search(segment):
        return segment
    if unicodedata.is_normalized("NFKC", segment) and not _beyond.search(segment):
        return segment  # the quick-check properties say that no form changes it, and no rule of our own does
    kept = [c if " " <= c <= "~" or c == "\n" or c in _JOINERS and _joined(segment, k) or c in _POWERS and k and segment[k - 1].isalpha() else _plain(c) for k, c in enumerate(segment)]
    plain = unicodedata.normalize("NFC", "".join(kept))
    return unicodedata.normalize("NFC", _word.sub(_own_letters, plain))


def canonical(text: str) -> str:
    """The canonical form of one text; it is a fixed point."""
    return _segment.sub(_normal, text) if _unstable.search(text) else text


@F.arrow_udf(StringType())
def _canonical_udf(b: pa.Array) -> pa.Array:
    return pa.array([None if x is None else canonical(x) for x in b.to_pylist()], pa.string())


def canonical_text(text: Column) -> Column:
    """The canonical form; null stays null and empty stays empty; stable texts never leave the JVM."""
    odd = text.rlike(f"[^{STABLE}]")
    return F.when(odd, _canonical_udf(F.when(odd, text))).otherwise(text)


def disguised(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """``(id, field, canonical)`` for each value that is not in canonical form.

    Null and empty values are in canonical form; repeated rows give repeated results; an empty table an empty one.
    """
    odd = [F.when(F.col(f).rlike(f"[^{STABLE}]"), F.struct(F.lit(f).alias("field"), F.col(f).alias("text"))) for f in fields]
    rows = df.select(F.col(id_col).alias("id"), F.explode(F.array_compact(F.array(*odd))).alias("v")).select("id", "v.field", "v.text")
    return rows.withColumn("canonical", _canonical_udf("text")).where("canonical <> text").select("id", "field", "canonical")
