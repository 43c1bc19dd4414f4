"""Variant spellings of persons and places (problem 3), by canonical rewritings and equi-joins.

Method.  Every name is rewritten to the canonical forms it may stand for: titles and legal forms go, token orders are
tried, initials, abbreviations and nicknames are kept as what they say of the given name, short forms of places
(St, Bg, s/...) are spelled out, regions go.  The forms, and for typing errors their one-letter deletions, are
exploded and equi-joined with the forms of the full names.  Which tokens are given names, and which of them are
nicknames of others, is learned from the whole table: a token that mostly leads is a given name, the better known of two
tokens deciding;
half or more of a nickname's family names also stand beside one other, more frequent given name.  A link is scored by the rarity of its rewriting, one
over the number of entities that have the form: a form that several entities share links to none of them.

Scale.  Everything works on distinct names.  All joins are on exact forms of the whole name, as hashes; no two names
are compared that share none, and names without a telling given part meet their family's entities as one number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import write_table
from .canonical import canonical
from .shingles import fold

# fixed values: titles before names, legal forms behind those of organisations, and short forms in names of places
TITLES = frozenset("fr frere br bro brother soeur sr sister past pasteur pastor rev reverend dr docteur doctor m mr mme mlle monsieur madame mademoiselle evangeliste evang pere mere abbe ancien diacre apotre prophete".split())
LEGAL = frozenset("sarl sas sasu snc gmbh ohg ltd ltd. limited llc llp plc inc inc. incorporated corp corp. corporation srl spa asbl s.a. s.a.r.l. s.a.s.".split())
SHORT = {"st": "saint", "ste": "sainte", "bg": "bourg", "mt": "mont", "mts": "monts", "s": "sur", "l": "les", "chateau": "chateau", "ch": "chateau"}


def _fold(name: str) -> str:
    return fold(canonical(name)).replace("œ", "oe").replace("’", "'").replace("`", "'").strip()


def place_key(name: str) -> str:
    """The one canonical form of a place."""
    x = _fold(name)
    x = re.sub(r"\s*\([^)]*\)\s*$", "", x)
    x = re.sub(r"\s*,.*$", "", x)
    x = re.sub(r"^(?:la )?(?:ville|commune|village|cite) (?:de la |de |du |des |d')", "", x)
    x = re.sub(r"\s*/\s*", " sur ", re.sub(r"\bs\s*/\s*", "sur ", x))
    words = re.findall(r"[a-z0-9']+", x)
    n = len(words)
    return " ".join(SHORT.get(w, w) if k == 0 and w != "s" and w != "l" or 0 < k < n - 1 and w in ("s", "l") else w for k, w in enumerate(words))


def readings(name: str) -> list[tuple[str, str]]:
    """Ways to read a person's name: ``(given, family)``, the given part as written but folded, or empty."""
    x = _fold(name)
    comma = [p.strip() for p in x.split(",")] if x.count(",") == 1 else None
    if comma and comma[0] and comma[1]:
        given = _no_titles(comma[1].split())
        return [("-".join(given), " ".join(_no_titles(comma[0].split())))]
    words = x.replace(",", " ").split()
    rest = _no_titles(words)
    out = [("", rest[0])] if len(rest) == 1 else []
    if len(rest) == 1 and len(words) == 2 and words[0] == "m.":
        out = [("m.", rest[0])]  # a title or an initial
    for k in range(1, len(rest)):
        out += [("-".join(rest[:k]), " ".join(rest[k:])), ("-".join(rest[k:]), " ".join(rest[:k]))]
    return [(g, f) for g, f in out if f and not f.endswith(".")]


def _no_titles(words: list[str]) -> list[str]:
    """Without titles at the front, and the legal form of an organisation at the end."""
    k, n = 0, len(words)
    while k < n - 1 and words[k].rstrip(".") in TITLES:
        k += 1
    while n > k + 1 and words[n - 1] in LEGAL:
        n -= 1
    return words[k:n]


def initials(given: str) -> str:
    return "".join(p[0] + "." if k == 0 else "-" + p[0] + "." for k, p in enumerate(q for q in given.split("-") if q))


def near(a: str, b: str) -> bool:
    """At most one letter inserted, deleted, replaced, or two neighbours swapped."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def deletions(x: str) -> list[str]:
    """The word and all that one deletion makes of it; words that are ``near`` share one of these."""
    return [x] + ([x[:k] + x[k + 1 :] for k in range(len(x))] if len(x) > 3 else [])


#: How sure the given part of a name speaks for a full given name; 0: it doesn't.
def agreement(part: str, given: str, learned: str | None) -> int:
    if part == given:
        return 6
    if not part:
        return 2
    if "." in part:
        if part == initials(given):
            return 5
        bare = part.rstrip(".")
        if len(bare) > 1 and given.replace("-", "").startswith(bare.replace("-", "")):
            return 5
        return 2 if part == "m." else 0
    if learned == given:
        return 4
    if len(part) > 3 and near(part, given):
        return 4
    return 1 if learned is None else 0


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(n, k, g, f, o) for n, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for o, (g, f) in enumerate(readings(n))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32()))], names=["name", "n", "given", "family", "order"])


def _explode_deletions(col: int, schema: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, keys = [], []
            for k, x in enumerate(b.column(col).to_pylist()):
                for d in deletions(x):
                    at.append(k)
                    keys.append(d)
            taken = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(keys, pa.string())], names=[*schema, "key"])

    return run


def _near_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ok = [near(x, y) for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        yield b.filter(pa.array(ok, pa.bool_()))


def _roots(forms: DataFrame, group: str, word: str) -> DataFrame:
    """``(group, word, root)``: rare spellings and the frequent one, ``near`` and of the same group, that they err from.

    ``forms`` has ``n`` occurrences and ``v`` different names for each ``(group, word)``.
    """
    base = forms.select(F.col(word).alias("w"), F.col(group).alias("g"), "n", "v")
    keyed = base.mapInArrow(_explode_deletions(0, ["w", "g", "n", "v"]), "w string, g string, n long, v long, key string")
    a, b = keyed.where("v <= 2"), keyed.select(F.col("w").alias("w2"), F.col("g"), F.col("n").alias("n2"), F.col("v").alias("v2"), "key")
    pairs = a.join(b, ["g", "key"]).where("w <> w2 and (v2 > v or v2 = v and n2 > n)").select("w", "w2", "g", "n2", "v2").distinct()
    pairs = pairs.mapInArrow(_near_pairs, "w string, w2 string, g string, n2 long, v2 long")
    best = pairs.groupBy("g", "w").agg(F.max_by("w2", F.struct("v2", "n2", "w2")).alias("root"))
    again = best.select(F.col("g"), F.col("w").alias("root"), F.col("root").alias("higher"))
    return best.join(again, ["g", "root"], "left").select(F.col("g").alias(group), F.col("w").alias(word), F.coalesce("higher", "root").alias("root"))


def _entity_forms(given: str, family: str, learned: str | None) -> set[str]:
    """Whole forms under which an entity may be written: family with an error at most, and a form of the given name."""
    plain = given.replace("-", "")
    said = {f"n {d}" for d in deletions(given)} | {f"i {initials(given)}"} | {f"p {plain[:k]}" for k in range(2, len(plain) + 1)}
    return {f"{d}|{s}" for d in deletions(family) for s in said}


def _asked_forms(given: str, family: str, learned: str | None) -> set[str]:
    """The forms that a reading of a name stands for, as far as they say much of the given name."""
    bare = given.rstrip(".")
    said = {f"n {d}" for d in deletions(bare)} if bare else set()
    if learned:
        said.add(f"n {learned}")
    if "." in given:
        said.add(f"i {given}")
        if len(bare) > 1:
            said.add(f"p {bare.replace('-', '')}")
    return {f"{d}|{s}" for d in deletions(family) for s in said}


def _forms(f):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, out = [], []
            for i, g, n, w in zip(*(b.column(k).to_pylist() for k in range(4))):
                forms = f(g, n, w)
                at += [i] * len(forms)
                out += forms
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(out, pa.string())], names=["a", "form"])

    return run


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ``name, given, family, g, f, learned`` the sure ones with their score."""
    for b in batches:
        name, part, own, g, f, learned = (b.column(k).to_pylist() for k in range(6))
        score = []
        for p, x, y, z, w in zip(part, own, g, f, learned):
            if x != z and not near(x, z):
                score.append(0)
                continue
            s = agreement(p, y, w)
            if p and not s and (q := agreement(p.rstrip("."), y, w)) == 4:
                s = q
            # an error in the family name as well as a weak given part is too little
            score.append(2 * s + 1 if x == z else 2 * s if s >= 4 else 0)
        keep = pa.array([s > 0 for s in score], pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(3).filter(keep), b.column(4).filter(keep), pa.array(score, pa.int32()).filter(keep)], names=["name", "g", "f", "score"])


def person_entities(names: DataFrame) -> DataFrame:
    """``(name, entity, score)`` of persons from ``(name, n)``; names that no or several entities claim are left out."""
    read = write_table(names.mapInArrow(_read, "name string, n long, given string, family string, order int"), "readings")
    plain = read.where("given <> '' and not contains(given, '.') and not contains(family, ' ')")
    # how often a token comes first of two, or after a comma: given names mostly do, family names mostly don't
    first = plain.withColumn("lead", F.when(F.contains("name", F.lit(",")), 3.0).otherwise(F.when(F.col("order") == 0, 1.0).otherwise(0.0)))
    first = first.select(F.explode(F.array(F.struct(F.col("given").alias("t"), F.col("lead").alias("x")), F.struct(F.col("family").alias("t"), F.lit(0.0).alias("x")))).alias("e"), "n", "order", F.contains("name", F.lit(",")).alias("comma"))
    first = first.where("order = 0 or comma or e.x > 0").groupBy("e.t").agg((F.sum(F.col("e.x") * F.col("n")) / F.sum(F.when(F.col("e.x") > 1, 3).otherwise(1) * F.col("n"))).alias("fs"), F.sum("n").alias("seen"))
    # the better known of the two tokens decides
    full = plain.join(first.select(F.col("t").alias("given"), "fs", "seen"), "given").join(first.select(F.col("t").alias("family"), F.col("fs").alias("fs2"), F.col("seen").alias("seen2")), "family")
    full = full.where("if(seen >= seen2, fs > 0.5, fs2 <= 0.5)")
    full = write_table(full.groupBy("given", "family").agg(F.sum("n").alias("n"), F.count_distinct("name").alias("v")), "full")
    # nicknames and errors: half or more of the family names beside them have another, more frequent given name
    wide = full.groupBy("given").agg(F.count("*").alias("k"))
    other = full.select(F.col("given").alias("g2"), "family", F.col("n").alias("n2"))
    shared = full.join(other, "family").where("given <> g2 and n2 > n").groupBy("given", "g2").agg(F.count("*").alias("c"), F.sum("n2").alias("m"))
    nick = shared.groupBy("given").agg(F.max_by("g2", F.struct("c", "m", "g2")).alias("of"), F.max("c").alias("c")).join(wide, "given").where("2 * c >= k").select("given", "of")
    more = nick.select(F.col("given").alias("of"), F.col("of").alias("further"))
    nick = nick.join(more, "of", "left").select("given", F.coalesce("further", "of").alias("of"))
    entity = full.join(nick, "given", "left").groupBy(F.coalesce("of", "given").alias("given"), "family").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    roots = _roots(entity, "given", "family")
    entity = write_table(entity.join(roots, ["given", "family"], "left").select("given", "family", F.coalesce("root", "family").alias("root"), "v", "n"), "entities")
    truth = entity.where("family = root").select(F.col("given").alias("g"), F.col("root").alias("f"))
    # votes for what a given part means, from families with one entity only
    alone = truth.groupBy("f").agg(F.count("*").alias("c"), F.first("g").alias("g")).where("c = 1").select(F.col("f").alias("family"), "g")
    votes = plain.join(alone, "family").where("given <> g").groupBy("given", "g").agg(F.count_distinct("family").alias("c"))
    top = votes.groupBy("given").agg(F.max_by("g", "c").alias("learned"), F.max("c").alias("c"), F.sum("c").alias("all")).where("c >= 0.6 * all")
    # forms that say much of the given name: whole forms of both sides are exploded and equi-joined
    asked = read.select("name", "given", "family").distinct().join(top.select("given", "learned"), "given", "left").select("name", "given", "family", "learned")
    asked = write_table(asked.withColumn("a", F.monotonically_increasing_id()), "asked")
    truth = write_table(truth.withColumn("e", F.monotonically_increasing_id()), "truth")
    x = asked.select("a", "given", "family", "learned").mapInArrow(_forms(_asked_forms), "a long, form string").select("a", F.xxhash64("form").alias("form"))
    y = truth.select("e", "g", "f", F.lit(None).cast("string").alias("learned")).mapInArrow(_forms(_entity_forms), "a long, form string").select(F.col("a").alias("e"), F.xxhash64("form").alias("form"))
    tried = x.join(y.hint("merge"), "form").select("a", "e").distinct().join(asked, "a").join(truth, "e").select("name", "given", "family", "g", "f", "learned")
    sure = tried.mapInArrow(_agree, "name string, g string, f string, score int").groupBy("name", "g", "f").agg(F.max("score").alias("score")).withColumn("weight", F.lit(1))
    # forms that say little (no given name, a title or an unknown word) fit all entities of the family alike, so their number will do
    of = truth.groupBy("f").agg(F.count("*").alias("weight"), F.min("g").alias("g"))
    little = F.when(F.col("given").isin("", "m."), 2).when(~F.contains("given", F.lit(".")) & F.col("learned").isNull(), 1)
    weak = asked.withColumn("s", little).where("s is not null").select("name", F.col("family").alias("f"), "s").join(of, "f")
    weak = weak.select("name", F.when(F.col("weight") == 1, F.col("g")).alias("g"), "f", (2 * F.col("s") + 1).alias("score"), F.col("weight").cast("int").alias("weight"))
    sure = sure.unionByName(weak).groupBy("name", "g", "f").agg(F.max("score").alias("score"), F.max("weight").alias("weight"))
    # rarity: of the best rewritings of a name, one must lead to a single entity
    w = Window.partitionBy("name")
    best = sure.withColumn("top", F.max("score").over(w)).where("score = top").withColumn("rarity", 1 / F.sum("weight").over(w)).where("rarity = 1")
    return best.select("name", F.concat_ws(" ", "g", "f").alias("entity"), "score")


def place_entities(names: DataFrame) -> DataFrame:
    """``(name, entity, score)`` of places from ``(name, n)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([place_key(x) for x in b.column(0).to_pylist()], pa.string())], names=["name", "n", "key"])

    keyed = write_table(names.mapInArrow(run, "name string, n long, key string").where("key <> ''").withColumn("kind", F.lit("place")), "places")
    forms = keyed.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    roots = _roots(forms, "kind", "key")
    out = keyed.join(roots, ["kind", "key"], "left")
    return out.select("name", F.coalesce("root", "key").alias("entity"), F.when(F.col("root").isNull(), 2).otherwise(1).alias("score"))


def linked(entities: DataFrame) -> DataFrame:
    """All pairs ``name_a < name_b`` of names of one entity."""
    a = entities.select("entity", F.col("name").alias("name_a"))
    b = entities.select("entity", F.col("name").alias("name_b"))
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b")


def distinct_names(names: DataFrame, col: str) -> DataFrame:
    """``(name, n)``; null and blank names are no names."""
    return names.select(F.col(col).cast("string").alias("name")).where("length(trim(name)) > 0").groupBy("name").agg(F.count("*").alias("n"))
