import random

import numpy as np
import pytest

from scriptorium.llm import junk as J

from ..conftest import DATA

NOUNS = "lampe porte source vigne nuit jardin moisson lumière maison colline rivière tempête prière parole montagne".split()
SENTENCES = ["La {} garde la {} de la {}.", "Ce n’est pas la {} qui cherche la {}, mais la {}.", "Quand la {} appelle la {}, il faut pardonner.", "Sans la {}, la {} de la {} demeure.", "Après la {} vient la {}, et après la {} vient le temps de veiller."]
GOODS = "promo soldes achat livraison discount comparatif avis".split()


# prose of other fields and languages than the corpus: no junk
ELSEWHERE = {
    "news": "The city council voted on Tuesday to close two schools after a long debate about falling numbers of pupils. Parents had asked for another year, but the mayor said that the money was not there. A final decision on the buildings will be taken in March, when the committee meets again.",
    "technical": "The cache keeps recently used pages in memory and writes dirty pages back to disk when the buffer fills. Each request first checks the cache index; on a miss the kernel allocates a page, reads the block and updates the index. Threads take a shared lock for lookups and an exclusive lock for eviction, which keeps contention low under heavy load.",
    "recipe": "Preheat the oven to 180 degrees. Whisk flour, baking powder and salt in a large bowl. Beat butter and sugar until pale, add eggs one at a time, then fold in the flour mixture. Spoon into a greased tin, bake for forty minutes and cool on a wire rack before slicing.",
    "medicine": "Insulin binds to receptors on the cell surface and triggers a cascade of phosphorylation events. Glucose transporters then move to the membrane, allowing muscle and fat cells to absorb sugar from the blood. In type two diabetes this response is blunted, so higher concentrations of the hormone are needed for the same effect.",
    "italian": "Il governo ha approvato ieri sera il nuovo piano per le ferrovie regionali. Secondo il ministro, i lavori cominceranno in primavera e dureranno almeno tre anni. Molti pendolari si lamentano da tempo dei ritardi e chiedono treni più puliti e puntuali.",
    "portuguese": "A câmara municipal decidiu ontem fechar a ponte velha durante seis meses para obras. Os moradores terão de usar o caminho pela serra, o que demora mais meia hora. O presidente disse que não havia outra solução e que a segurança vem primeiro.",
    "german": "Der Stadtrat hat am Montag beschlossen, die alte Brücke zu sperren. Viele Pendler müssen nun einen Umweg von zwölf Kilometern fahren. Die Reparatur soll im nächsten Frühjahr beginnen und etwa vier Millionen Euro kosten.",
}
SHOPS = {
    "shoes": "cheap shoes buy shoes online best shoes discount shoes running shoes sale shoes outlet shoes cheap shoes buy shoes online best shoes discount shoes",
    "hotels": "best hotel Paris cheap hotel Paris book hotel Paris hotel deals Paris luxury hotel Paris hotel near me Paris hotel discount Paris cheap hotel Paris",
}


def corpus():
    rng = random.Random(8)
    s = lambda: rng.choice(SENTENCES).format(*[rng.choice(NOUNS) for _ in range(3)])
    pair = lambda: f"{rng.choice(NOUNS[:4])} {rng.choice(GOODS)}"
    rows = {k: " ".join(s() for _ in range(rng.randint(3, 30))) for k in range(300)}
    rows[1000] = " ".join(rng.choice(NOUNS[:2]) for _ in range(200))
    rows[1001] = ", ".join(pair() for _ in range(80))
    rows[1002] = " ".join(f"#{rng.choice(NOUNS)}{rng.choice(GOODS)}" for _ in range(40))
    rows[1003] = "\n".join(f"- [{pair()}](https://shop.x{k}.example/a?id={k})" for k in range(30))
    rows[1004] = " | ".join(f'<a href="http://m.y{k}.test/z">{pair()}</a>' for k in range(30))
    rows[1005] = "\n".join(f"http://z{k}.invalid/a/b" for k in range(30))
    rows[1006] = s() + " " + ", ".join(pair() for _ in range(80))
    rows[2000] = "\n\n".join([s(), "La lampe garde la porte de la nuit."] * 15)  # a refrain
    rows[2001] = "\n".join(f"{k}. {s()}" for k in range(1, 30))  # a list of sentences
    rows[2002] = " ".join(s() for _ in range(25)) + "\nhttps://a.example/x\nhttps://b.example/y"
    rows[2003] = " ".join(s() for _ in range(25)) + " #lampe #porte"
    rows[2004], rows[2005], rows[2006] = None, "", " \n "
    rows[2007] = "1960 12 34 " + s()
    rows[2008] = s() + "\n" + "\n".join(f"Pour la {rng.choice(NOUNS)}, nous te rendons grâce." for _ in range(25))  # a litany
    return rows


@pytest.fixture(scope="module")
def shares(spark):
    df = spark.createDataFrame([(k, t, 0.5) for k, t in corpus().items()], "doc_id long, text string, share double")
    return {r.id: r.share for r in J.junk_shares(df, "doc_id", "text").collect()}


@pytest.mark.parametrize("k", range(1000, 1007))
def test_junk(shares, k):
    assert shares[k] > 0.5


@pytest.mark.parametrize("k", range(2000, 2009))
def test_real(shares, k):
    assert shares[k] <= 0.5


def test_no_prose_is_flagged(shares):
    assert sum(v > 0.5 for k, v in shares.items() if k < 1000) == 0


@pytest.fixture(scope="module")
def elsewhere(spark):
    """Paragraphs beside a real corpus: the documents of the smallest tables."""
    more = [(-k - 1, t, None) for k, t in enumerate([*ELSEWHERE.values(), *SHOPS.values()])]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    got = {r.id: r.share for r in J.junk_shares(docs, "doc_id", "text", "lang").where("id < 0").collect()}
    return {k: got[-n - 1] for n, k in enumerate([*ELSEWHERE, *SHOPS])}


@pytest.mark.parametrize("k", [*ELSEWHERE, *SHOPS])
def test_prose_of_other_fields(elsewhere, k):
    assert (elsewhere[k] > 0.5) == (k in SHOPS)


def test_frames_of_litanies_point_back():
    lexicon = J.Lexicon(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64))
    s = J.Classed(["Pour la nuit, nous te rendons grâce. Pour le pain, nous te rendons grâce."], lexicon).s
    to = s.told_before(np.ones(len(s.sentence), bool), np.zeros(len(s.sentence), bool))
    assert to.tolist() == [0, 1, 2, 3, 4, 5, 6, 0, 8, 9, 3, 4, 5, 6]


def test_copies_and_empty_table(spark):
    rows = [(k, t) for k, t in corpus().items()] + [(5000, corpus()[1001]), (5000, corpus()[1001])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = J.junk_shares(df, "doc_id", "text").where("id in (1001, 5000)").collect()
    assert len(got) == 3 and len({round(r.share, 9) for r in got}) == 1
    assert J.junk_shares(df.limit(0), "doc_id", "text").isEmpty()


def test_ids_choose_no_sample(spark):
    """Every text counts, whatever its id."""

    def shares_of(shift):
        df = spark.createDataFrame([(k + shift, t) for k, t in corpus().items()], "doc_id long, text string")
        return {r.id - shift: round(r.share, 9) for r in J.junk_shares(df, "doc_id", "text").collect()}

    assert shares_of(0) == shares_of(10_000)
