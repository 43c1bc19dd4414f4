import random
import re

import pytest
from pyspark.sql import functions as F

from scriptorium.sources import files
from scriptorium.functions import align, norm, refs, similarity
from scriptorium.functions import text as tx
from scriptorium.plans import catalogue

FRENCH = [
    ("Mt 24:6", ["Matthieu 24:6"]), ("Math. 24, 6", ["Matthieu 24:6"]), ("Matth 24:5-7", ["Matthieu 24:5-7"]), ("Hébreux 8:13-13:8", ["Hébreux 8:13"]),
    ("Mat. 3:7; 12:34", ["Matthieu 3:7", "Matthieu 12:34"]), ("Ézéchiel 26, 27 et 28", ["Ézéchiel 26", "Ézéchiel 27", "Ézéchiel 28"]), ("Jude 23", ["Jude 1:23"]), ("Jude 1", ["Jude 1"]),
    ("Sophonie 155", []), ("Luc chapitre 18 verset 9", ["Luc 18:9"]), ("le verset 15 du chapitre 3 de la Genèse", ["Genèse 3:15"]), ("Jean 1:1 et 14", ["Jean 1:1,14"]),
    ("Éphésiens 5.2 et 2 Timothée 1:3", ["Éphésiens 5:2", "2 Timothée 1:3"]), ("1Cor 5:20-21", ["1 Corinthiens 5:20-21"]), ("Première Corinthiens 5:20", ["1 Corinthiens 5:20"]),
    ("Matthieu 13 :\n\n> **41** Le Fils **42** et **43** Alors", ["Matthieu 13:41-43"]), ("![x](data:Mt7 Mt 7:1)", []), ("", []),
]
SPOKEN = [
    ("2 Corinthiens, chapitre 3", ["2 Corinthiens 3"]), ("chapitre 3.20-23 des Actes", ["Actes 3:20-23"]), ("le premier verset du chapitre 6 de Matthieu", ["Matthieu 6:1"]), ("les versets 15 à 27 du chapitre 2 de l’épître aux Romains", ["Romains 2:15-27"]),
    ("Luc au chapitre 18, à partir du verset 9", ["Luc 18:9"]), ("le 3ème verset du chapitre 4 de Jean", ["Jean 4:3"]), ("Jean chapitre 3, versets 12 et 15", ["Jean 3:12,15"]), ("on a lu le chapitre 11", []), ("chapitre 17 de Jean-Baptiste", []), ("Genèse chapitre 1 du verset 1 au verset 6", ["Genèse 1:1-6"]), ("chapitre", []), ("chapitre 5", []),
]
FRENCH += SPOKEN
ENGLISH = [("First John, 1st chapter", ["1 John 1"]), ("the 13th chapter of Ex-…of Genesis", ["Genesis 13"]), ("John the 3rd chapter, the 3rd and 4th verses", ["John 3:3,4"]), ("the 4th chapter of Ephesians, 34th verse and 35th verse", ["Ephesians 4:34,35"]), ("Matt 24:6", ["Matthew 24:6"]), ("First Corinthians 5, 20-21", ["1 Corinthians 5:20-21"]), ("Saint John the 4th chapter, the 23rd verse", ["John 4:23"]), ("my job 9", []), ("In the 20th chapter of Numbers.", ["Numbers 20"]), ("Hebrews 13:12 and 13", ["Hebrews 13:12,13"])]


@pytest.mark.parametrize("text,want", FRENCH)
def test_french_citations(text, want):
    assert [r for _, _, r in refs.citations(text)] == want
    assert all(text[i : i + len(t)] == t for i, t, _ in refs.citations(text))


@pytest.mark.parametrize("text,want", ENGLISH)
def test_english_citations(text, want):
    assert [r for _, _, r in refs.citations(text, "en")] == want


def test_reference_columns(spark):
    df = spark.createDataFrame([("Jean 5:19-21,24",), ("Jude 1",), (None,)], "r string")
    got = df.select(refs.verses_of(F.col("r")).alias("v"), refs.url(F.col("r")).alias("u"), refs.book_number(refs.parse_graph(F.col("r"))["book"]).alias("b")).collect()
    assert got[0].v == [19, 20, 21, 24] and got[0].u == "/bible/jean/5/#v19" and got[0].b == 43
    assert got[1].v == [] and got[2].u is None


def one(spark, f, *values):
    names = [f"c{k}" for k in range(len(values))]
    df = spark.createDataFrame([values], ", ".join(f"{n} {'array<int>' if isinstance(v, list) else 'string'}" for n, v in zip(names, values)))
    return df.select(f(*[F.col(n) for n in names]).alias("x")).first().x


def test_normal_forms(spark):
    assert one(spark, norm.key_fr, "  I  Cor. ") == "i cor"
    assert one(spark, norm.token_id, "Été — à l’œuvre!") == "ete_a_l_uvre" or one(spark, norm.token_id, "Été — à l’œuvre!").startswith("ete_a_l")
    assert one(spark, norm.token_id, "!!!") == "x"
    assert one(spark, norm.ref_id, "Jean 3:16-18,20") == "jean_3_16to18and20"
    assert one(spark, norm.slug, "Cœur d’été") == "coeur-d-ete"
    assert one(spark, norm.spelling_key, "Frère José") == "jose"
    assert one(spark, norm.unmark, "> **Voir** [ici](http://x) \\*") == "Voir ici *"
    assert one(spark, norm.words, None) is None


def test_text_transforms(spark):
    assert one(spark, tx.date_fr, "2012-10-12") == "12 octobre 2012" and one(spark, tx.date_fr, "1999") == "1999"
    assert one(spark, tx.reading_minutes, "a " * 500) == 3 and one(spark, tx.reading_minutes, None) == 1
    assert one(spark, tx.french_spacing, "Il dit : venez ; qui ?") == "Il dit\u202f: venez\u202f; qui\u202f?"
    assert one(spark, tx.french_spacing, "https://a.b/c?d=1") == "https://a.b/c?d=1"
    assert one(spark, tx.html_to_text, "<p>a&amp;b</p><script>x</script><b>c</b>") == "a&b c"
    assert one(spark, tx.dot_leaders, "a........b") == "a… b"
    assert one(spark, tx.date_from_id, "63-0112E") == "1963-01-12" and one(spark, tx.date_from_id, "63-0100") == "1963-01"
    assert one(spark, tx.date_from_name, "lc_mars_1972.pdf") == "1972-03" and one(spark, tx.date_from_name, "video_05_1999.mp4") == "1999-05"
    assert one(spark, tx.part_number, "La foi (3)") == 3 and one(spark, tx.part_number, "Deuxième partie") == 2
    assert one(spark, tx.sentence_case, "Le Soir de Mars") == "Le soir de mars"
    assert one(spark, tx.opening, "Titre\nLieu\n" + "mot " * 30 + "\nLieu") == ["Titre"]
    assert one(spark, tx.clean_lines, "a\n- 12 -\n\n\n\nb\n3 sur 9") == "a\n\nb"


def test_chunks_and_excerpts():
    text = "\n\n".join(["mot " * 100] * 20)
    assert all(len(c) <= 1000 for c in tx.chunks(text, 1000)) and "".join("".join(tx.chunks(text, 1000)).split()) == "".join(text.split())
    assert tx.chunks("") == [""] and tx.word_chunks("") == [""]
    assert tx.excerpt_of("mot " * 130 + "\n\n" + "mot " * 100) == ("mot " * 130).strip()
    cut = tx.excerpt_of("mot " * 60 + "\n\n" + "Une phrase de cinq mots. " * 60)
    assert 120 <= len(cut.split()) <= 200 and cut.endswith(".")
    assert "| a | b |" in tx.markdown_of("<table><tr><td>a</td><td>b</td></tr></table>") and tx.markdown_of("<p>x <b> y </b></p>") == "x  **y**"


def test_alignment():
    assert align.anchor(["a", "b"], ["d", "e", "f"], "x a b C d e f".split()) == (3, 4)
    assert align.anchor(["a", "b"], ["d", "e", "f"], "a b C d e f a b Z d e f".split()) is None
    text, left = align.restore_spots("a b ? d e f".split(), [2], "a b C d e f".split())
    assert text == "a b C d e f".split() and left == []
    assert align.restore_words("l eglise est grande", "l église est grande") == "l église est grande"
    assert align.with_signs("bonjour monde", "bonjour, monde!") == "bonjour, monde!"
    assert align.strip_headers("un mot\nLE TITRE\nqui suit", "LE TITRE\nx\nLE TITRE\ny\nLE TITRE") == "un mot qui suit"


def test_similarity(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], [])], "x array<string>, y array<string>")
    assert [r[0] for r in df.select(similarity.jaccard(F.col("x"), F.col("y"))).collect()] == [pytest.approx(1 / 3), 0.0]
    words = spark.createDataFrame([("un deux trois quatre cinq six".split(),), (["a"],)], "w array<string>")
    assert [len(r[0]) for r in words.select(similarity.shingles(F.col("w"), 5)).collect()] == [2, 0]
    assert one(spark, similarity.common_prefix, "L’Art", "l'arbre") == 4


def test_words_in_one_pass_are_the_words(spark):
    every = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    rows = [(" ".join(f"a{c}b {c}" for c in every[k : k + 512]),) for k in range(0, len(every), 512)]
    rows += [("",), (" - ",), (None,), ("É",), ("x y l'été D’ÎLE e\u0301\u0302te",)]
    df = spark.createDataFrame(rows, "t string").select(norm.words(F.col("t")).alias("w"), norm.words_once(F.col("t")).alias("o"), norm.words_once(F.col("t"), 2).alias("p"))
    for w, o, p in df.collect():
        assert o == w and p == (None if w is None else [x for x in w if len(x) > 1])


def test_bigrams_are_phrases_of_two_words(spark):
    rng, few = random.Random(5), ["le", "grace", "peut", "dans", "mot", "l'amour", "qu'a", "d'", "lorsqu'avec", "jour's", "'", "foi2"]
    rows = [([],), (["grace"],), (["dans", "grace"],)] + [([rng.choice(few) for _ in range(rng.randrange(30))],) for _ in range(200)] + [([rng.choice(few[:5]) for _ in range(9)],) for _ in range(50)]
    w = F.col("w")
    df = spark.createDataFrame(rows, "w array<string>").select(F.filter(w, lambda x: F.length(x) > 1).alias("w")).select("w", F.array_join(similarity.ngrams(w, 2), "|").alias("want"), similarity.bigrams(w, "|").alias("got"))
    got = df.collect()
    assert [(r.w, r.got, r.want) for r in got if r.got != r.want] == [] and any("amour" in r.got for r in got)
    assert one(spark, lambda c: similarity.bigrams(F.split(c, " "), "|"), None) is None


def test_whole_texts_are_aligned(spark, tmp_path):
    """Everything of a text counts, however far from its start."""
    source = [f"mot{k}" for k in range(400)]
    one, two = list(source), list(source)
    one[350] = "faux"
    two[350:352] = ["faux", "faux"]
    rows = [(0, "s", " ".join(source), None), (1, "a", " ".join(one), "s"), (2, "b", " ".join(two), "s")]
    df = spark.createDataFrame(rows, "md_id long, path string, body string, duplicate_of string")
    df.withColumn("ingested_at", F.current_timestamp()).write.parquet(f"{tmp_path}/markdown.parquet")
    got = {q: dict(map(tuple, catalogue.QUERIES[q](spark, str(tmp_path)).collect())) for q in ("align_anchor", "align_fixpoint", "align_lcs")}
    assert got["align_anchor"] == {1: 395 - 5, 2: 395 - 7}
    assert got["align_fixpoint"] == {1: 0, 2: 2}
    assert got["align_lcs"] == {k: longest([c for c in t if c.isalpha()], [c for c in rows[0][2] if c.isalpha()]) for k, t in ((1, rows[1][2]), (2, rows[2][2]))}


def longest(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        last = row
        row = [0]
        for j, b in enumerate(y):
            row.append(last[j] + 1 if a == b else max(last[j + 1], row[j]))
    return row[-1]


def test_common_letters_are_the_longest():
    rng = random.Random(3)
    for n in (0, 1, 7, 40, 300):
        a, b = ("".join(rng.choice("abcé, ") for _ in range(rng.randint(n // 2, n))) for _ in range(2))
        got = align.common_letters(a, b)
        assert got == sorted(got) and len({j for _, j in got}) == len(got) and all(align.fold(a[i]) == align.fold(b[j]) for i, j in got)
        assert len(got) == longest([align.fold(c) for c in a if c.isalpha()], [align.fold(c) for c in b if c.isalpha()])


def test_spots_restore_one_another_in_long_texts():
    source = [f"m{k % 50}" if k % 3 else f"n{k}" for k in range(900)]
    text = list(source)
    for k in (500, 503, 506, 890):
        text[k] = "?"
    assert align.differing(text, source) == [500, 503, 506, 890]
    assert align.restore_spots(text, align.differing(text, source), source) == (source, [])


def test_signs_of_whole_texts():
    for s in ("« Où ? », dit-il. — “Non!”", "(1963) : l’an 12, p. 7;", "a\n\n- b\n> **c** d…", "", "?!", "x" * 500 + ", y", "e\u0301, a\u0300!", "½, ²;"):
        assert align.with_signs(re.sub(r"[^\w\s̀́]", "", s), s) == s
    assert align.with_signs("un mot\nautre", "un mot, autre") == "un mot,\nautre"
    assert align.with_signs("un mot autre", "un mot,\nautre") == "un mot, autre"
    assert align.with_signs("un; mot", "un, mot!") == "un; mot!"
    assert align.with_signs("un deux", "trois, quatre") == "un deux"


def test_whole_bodies_and_pages(spark, tmp_path):
    bodies = ["« Où ? », dit-il.", "L’an 1963 — “page” " * 20, "Ωμέγα,\u2003βήτα\u00a0!", None]
    spark.createDataFrame(list(enumerate(bodies)), "md_id long, body string").write.parquet(f"{tmp_path}/markdown.parquet")
    assert dict(map(tuple, catalogue.QUERIES["src_ocr_merge"](spark, str(tmp_path)).collect())) == {k: b for k, b in enumerate(bodies) if b}
    pages = ["<p>a&amp;b</p>", "Ω <b>x</b>y &lt;i&gt; &amp;lt;", "<DIV\nclass='a'>œ — “q”</DIV>", "&nbsp;x&quot;&#39;&rsquo;", "", None]
    spark.createDataFrame(list(enumerate(pages)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {0: "a&b", 1: "Ω xy <i> &lt;", 2: "œ — “q”", 3: "x\"'’", 4: ""}
    assert dict(map(tuple, catalogue.QUERIES["txt_html_to_text"](spark, str(tmp_path)).collect())) == want


def test_docx_round_trip():
    for text in ("", "Été <b>&amp;</b>\n\nfin\t.", "\r\x07_x0041_ \ufffe", "a" * 10_000):
        assert files.docx_text(files.docx_file(text)) == text


def test_retry_in_halves():
    def small(content):
        if len(content) > 5:
            raise ValueError("too long")
        return content.decode()

    text = "un été à la mer, très très long"
    assert files.with_retry(small, text.encode(), 30) == text
    with pytest.raises(ValueError):
        files.with_retry(small, text.encode(), 1)
    with pytest.raises(UnicodeDecodeError):
        files.with_retry(lambda b: b.decode(), b"\xff", 5)
