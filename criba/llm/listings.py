"""Product listings that describe the same item, by a reference dictionary of brands.

Brand phrases come from the trusted catalogue and from recurring words of
listings; an Aho-Corasick automaton finds them in every text; of the matches the
longest consistent one counts; then form, strength, content and packs decide.

No list of dosage forms is built in. The catalogue says the form of its entries
by a code; the words that go with one code, in the catalogue and in listings of
a brand sold in one form only, are the words of that form. What kind of content
a form has (pieces, grams, millilitres) is told by its catalogue entries too.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from criba.session import cut_lineage


@dataclass(frozen=True)
class ListingRules:
    """Parameters of ``products``.

    purity      least share of a word's brands that one form has, for a word of that form
    brands      least number of brands that show it, for words that the catalogue lacks
    letters     least letters of a word that abbreviates another, and of a word whose slip is mended
    spread      most texts of known brands that may have a brand mined from listings, as a share of its own texts
    shard       phrases of one automaton
    block       texts that one automaton runs over where there are several shards
    """

    purity: float = 0.9
    brands: int = 3
    letters: int = 3
    spread: float = 0.1
    shard: int = 200_000
    block: int = 200_000


# Milligrams in each unit of mass.
MILLIGRAMS = {"MG": 1.0, "MGS": 1.0, "MCG": 0.001, "G": 1000.0, "GR": 1000.0, "KG": 1_000_000.0}
# Words of units, which are no words of forms or brands.
UNIT_WORDS = ("MG", "MGS", "MCG", "G", "GR", "GRS", "GRAMOS", "KG", "ML", "L", "LT", "UI", "X", "C")
# Multiples said in a word beside a container or in one word with PACK.
MULTIPLES = {"DUO": 2, "DOBLE": 2, "TRIO": 3, "TRI": 3, "TRIPLE": 3, "CUADRUPLE": 4, "SIX": 6}

_TIMES_WORD = "|".join(MULTIPLES)
_HOLDER = r"(?:CAJA|PAQUETE|PAQ\.?|PACK|ESTUCHE|FRASCO|TUBO|ENVASE)"
_PIECE = r"(?: ?(?:PIEZAS?|PZAS?|PZS?|UNIDADES|UDS|CAJAS)\b)?"
#: Phrases that can only speak of packs, and those whose number may also be the content.
_PACKS = (
    re.compile(r"(?<![A-Z0-9.])(\d{1,2}) ?X ?1(?![\d.])"),
    re.compile(r"(?<![\d.])(\d{1,2}) ?(?:PACKS?|CAJAS|PAQUETES|PAQS|ESTUCHES|FRASCOS|TUBOS)\b"),
    re.compile(rf"\b{_HOLDER} ({_TIMES_WORD})\b"),
    re.compile(rf"\b({_TIMES_WORD}) ?(?:PACK|PAQUETE|CAJA)\b"),
    re.compile(r"\b(DUO|TRIO)\b"),
)
_OPEN_PACKS = (
    re.compile(rf"\b(?:PACK|PAQUETE|PAQ)\b\.? ?(?:DE |CON |C/ ?|X ?)?(\d{{1,2}})(?![\d.]){_PIECE}"),
    re.compile(r"(?<![A-Z0-9])X ?(\d{1,3})(?![\d.])(?! ?(?:MG|MCG|ML|GR?\b|CAJA))"),
)
_NUMBER = r"(?<![\d.])(\d+(?:\.\d+)?)"
# Without a sign between, only a spoonful passes for the dose's volume: 60 ML would be the bottle.
_PER_DOSE = re.compile(_NUMBER + r" ?(MGS|MG|MCG|GR|G)(?: ?/ ?(?=\d)| ?EN (?=\d)| ?(?=(?:[1-9]|1[0-5]) ?ML\b))(\d+(?:\.\d+)?) ?ML\b")
_PER_UNIT = re.compile(_NUMBER + r" ?(MGS|MG|MCG) ?/ ?(?:ML|G)\b")
_PERCENT = re.compile(_NUMBER + r" ?%")
_MASS = re.compile(_NUMBER + r" ?(MGS|MG|MCG|GR|G)\b")
_WEIGHT = re.compile(_NUMBER + r" ?(KG|GRAMOS|GR|G)\b")
_VOLUME = re.compile(_NUMBER + r" ?(ML|L)\b")
_COUNT = re.compile(r"(?<![\d.])(\d+)(?![\d.])")
_WORD = re.compile(r"[A-Z]+")

PIECES, GRAMS, MILLILITRES = "piezas", "gramos", "mililitros"


def plain(text: str) -> str:
    """Upper case without accents, commas as blanks, blanks single."""
    bare = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    return " ".join(bare.upper().replace(",", " ").split())


def packs_of(text: str) -> tuple[int, int | None, str]:
    """Packs that a plain text surely names (1 where it names none), the number of an open phrase, and the rest."""
    sure, open_number = [], None
    for pattern in _PACKS:
        while m := pattern.search(text):
            sure.append(int(MULTIPLES.get(m[1], m[1])))
            text = text[: m.start()] + " " + text[m.end() :]
    for pattern in _OPEN_PACKS:
        if m := pattern.search(text):
            open_number, text = int(m[1]), text[: m.start()] + " " + text[m.end() :]
            break
    return max(sure, default=1) or 1, open_number, text


def content_kind(text: str) -> str:
    """Kind of content that a plain text speaks of by itself: a volume, else a weight beside a concentration, else pieces."""
    _, _, rest = packs_of(text)
    told = False
    for pattern in (_PER_UNIT, _PER_DOSE, _PERCENT):
        rest, n = pattern.subn(" ", rest)
        told = told or n > 0
    if _VOLUME.search(rest):
        return MILLILITRES
    return GRAMS if told and _WEIGHT.search(rest) else PIECES


def attributes(text: str, kind: str) -> tuple[float | None, float | None, int]:
    """Strength, content and packs of a plain text of a form with that kind of content; None where it doesn't say.

    Strength is in milligrams a piece where the content is pieces, else in
    milligrams a millilitre or gram (one percent is ten of them). Content is in
    pieces, grams or millilitres. Packs are 1 unless the text says otherwise; the
    number of ``X 20`` or ``PAQUETE 20`` is the content where no other number is.
    """
    packs, open_number, rest = packs_of(text)

    def take(pattern: re.Pattern[str]) -> re.Match[str] | None:
        nonlocal rest
        if match := pattern.search(rest):
            rest = rest[: match.start()] + " " + rest[match.end() :]
        return match

    strength = None
    if m := take(_PER_UNIT):
        strength = float(m[1]) * MILLIGRAMS[m[2]]
    elif kind == MILLILITRES and (m := take(_PER_DOSE)):
        strength = float(m[1]) * MILLIGRAMS[m[2]] / float(m[3]) if float(m[3]) else None
    elif m := take(_PERCENT):
        strength = float(m[1]) * 10
    elif kind == PIECES and (m := take(_MASS)):
        strength = float(m[1]) * MILLIGRAMS[m[2]]
    if kind == GRAMS:
        m = take(_WEIGHT)
        content = float(m[1]) * (1000 if m[2] == "KG" else 1) if m else None
    elif kind == MILLILITRES:
        m = take(_VOLUME)
        content = float(m[1]) * (1000 if m[2] == "L" else 1) if m else None
    else:
        counts = _COUNT.findall(rest)
        content = float(counts[0]) if counts else None
    if kind == PIECES and content is None and open_number:
        content, open_number = float(open_number), None
    if open_number:
        packs = max(packs, open_number)
    rounded = lambda x: None if x is None else round(x, 6)
    return rounded(strength), rounded(content), packs


def brand_phrase(brand: str | None, laboratory: str | None) -> str | None:
    """Brand words of a catalogue entry; a last word that only abbreviates the laboratory goes."""
    if not brand:
        return None
    words = _WORD.findall(plain(brand))
    if len(words) > 1 and laboratory and len(words[-1]) <= 4 and plain(laboratory).startswith(words[-1]):
        words.pop()
    return " ".join(words) or None


def tokenized(records: DataFrame) -> DataFrame:
    """Records with their plain text, its words, a key of all its signs, and what a catalogue entry says of itself.

    ``clave, fuente, marca, forma, texto, palabras, firma, clase, ajenas``: ``firma``
    is equal for texts of equal words and numbers in any order, ``clase`` the kind of content
    that the text speaks of, ``ajenas`` the words of molecule and laboratory.
    """
    schema = "clave string, fuente string, marca string, forma string, texto string, palabras array<string>, firma string, clase string, ajenas array<string>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [plain(t) for t in batch["texto"]]
            yield pd.DataFrame(
                {
                    "clave": batch["clave"],
                    "fuente": batch["fuente"],
                    "marca": [brand_phrase(b, l) for b, l in zip(batch["marca"], batch["laboratorio"])],
                    "forma": batch["forma"],
                    "texto": texts,
                    "palabras": [list(dict.fromkeys(_WORD.findall(t))) for t in texts],
                    "firma": [" ".join(sorted(re.findall(r"[A-Z]+|[\d.]*\d|[^\s\dA-Z]", t))) for t in texts],
                    "clase": [content_kind(t) for t in texts],
                    "ajenas": [list(dict.fromkeys(_WORD.findall(plain(f"{m or ''} {l or ''}")))) for m, l in zip(batch["molecula"], batch["laboratorio"])],
                }
            )

    return records.select("clave", "fuente", "texto", "marca", "laboratorio", "molecula", "forma").mapInPandas(run, schema)


def dictionary(catalogue: DataFrame) -> DataFrame:
    """Brand phrases with the forms they come in: ``frase, formas``.

    A phrase that another one continues by a short word (an abbreviation whose
    laboratory is unknown) stands for both.
    """
    phrases = catalogue.where("marca is not null").groupBy("marca").agg(F.collect_set("forma").alias("formas"))
    words = F.split("marca", " ")
    shorter = F.when((F.size(words) > 1) & (F.length(F.element_at(words, -1)) <= 4), F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), " "))
    known = phrases.select(F.col("marca").alias("corta"))
    named = phrases.withColumn("corta", shorter).join(known.withColumn("hay", F.lit(True)), "corta", "left")
    return (
        named.select(F.when(F.col("hay"), F.col("corta")).otherwise(F.col("marca")).alias("frase"), F.explode_outer("formas").alias("forma"))
        .groupBy("frase")
        .agg(F.collect_set("forma").alias("formas"))
    )


def _automaton(phrases: list[str]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for phrase in phrases:
        out.add_word(f" {phrase} ", phrase)
    if len(out):
        out.make_automaton()
    return out


def _hits(automaton: ahocorasick.Automaton, batch: pd.DataFrame) -> pd.DataFrame:
    """Phrases on whole words of each text."""
    rows = []
    if len(automaton):
        for key, text in zip(batch["clave"], batch["texto"]):
            rows += [(key, p) for p in {p for _, p in automaton.iter(f" {' '.join(_WORD.findall(text))} ")}]
    return pd.DataFrame(rows, columns=["clave", "frase"])


def find_phrases(texts: DataFrame, phrases: DataFrame, rules: ListingRules = ListingRules()) -> DataFrame:
    """``clave, frase``: every phrase of the dictionary that stands on whole words of a text.

    A dictionary of one shard, which is of a checked size, goes to the tasks that
    read the texts; a larger one is cut into shards and the texts into blocks, and
    an automaton for each shard runs over each block.
    """
    schema = "clave string, frase string"
    count = phrases.count()
    if count <= rules.shard:
        shared = phrases.sparkSession.sparkContext.broadcast([r[0] for r in phrases.select("frase").collect()])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            automaton = _automaton(shared.value)
            for batch in batches:
                yield _hits(automaton, batch)

        return texts.select("clave", "texto").mapInPandas(run, schema)
    shards, blocks = -(-count // rules.shard), max(16, -(-texts.count() // rules.block))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = phrases.select("frase", F.pmod(F.hash("frase"), F.lit(shards)).alias("parte")).withColumn("bloque", spread(blocks))
    right = texts.select("clave", "texto").withColumn("bloque", F.pmod(F.hash("clave"), F.lit(blocks))).withColumn("parte", spread(shards))
    scan = lambda phrases, texts: _hits(_automaton(list(phrases["frase"])), texts)
    return left.groupBy("parte", "bloque").cogroup(right.groupBy("parte", "bloque")).applyInPandas(scan, schema)


def form_words(catalogue: DataFrame, listings: DataFrame, rules: ListingRules = ListingRules()) -> DataFrame:
    """Words that speak of one form: ``palabra, forma, peso``.

    catalogue: ``marca, forma, palabras, ajenas``; listings: ``marca, forma, palabras`` of
    listings whose brand is sold in one form. A word speaks of a form that has at
    least ``purity`` of the brands that show it; one that no catalogue entry has needs
    ``brands`` of them. Words of brands, molecules, laboratories and units are none.
    ``peso`` is the number of brands.
    """
    shown = catalogue.where("forma is not null").select("marca", "forma", F.explode("palabras").alias("palabra"), F.lit(1).alias("propia"))
    shown = shown.unionByName(listings.select("marca", "forma", F.explode("palabras").alias("palabra"), F.lit(0).alias("propia")))
    brands = catalogue.where("marca is not null").select(F.explode(F.split("marca", " ")).alias("palabra"))
    none = catalogue.select(F.explode("ajenas").alias("palabra")).unionByName(brands).distinct()
    by_form = shown.where(~F.col("palabra").isin(*UNIT_WORDS)).groupBy("palabra", "forma").agg(F.count_distinct("marca").alias("marcas"), F.max("propia").alias("propia"))
    told = by_form.groupBy("palabra").agg(F.max_by(F.struct("forma", "marcas"), F.struct("marcas", "forma")).alias("x"), F.sum("marcas").alias("todas"), F.max("propia").alias("propia"))
    kept = told.where((F.col("x.marcas") >= rules.purity * F.col("todas")) & ((F.col("propia") == 1) | (F.col("x.marcas") >= rules.brands)))
    return kept.join(none, "palabra", "left_anti").select("palabra", F.col("x.forma").alias("forma"), F.col("x.marcas").alias("peso"))


def _abbreviates(short: Column, long: Column, letters: int) -> Column:
    """True where ``short``, its plural S aside, is how ``long`` begins, or its letters in order with the same first and last one."""
    skeleton = F.concat(F.lit("^"), F.regexp_replace(short, "(?<=.)(?=.)", ".*"), F.lit("$"))
    stem = F.regexp_replace(short, "S$", "")
    return (F.length(short) <= F.length(long)) & (((F.length(stem) >= letters) & long.startswith(stem)) | F.coalesce(F.rlike(long, skeleton), F.lit(False)))


def text_forms(texts: DataFrame, words: DataFrame, evidence: DataFrame, rules: ListingRules = ListingRules()) -> DataFrame:
    """``clave, forma`` of the texts that name a form.

    Of several words of forms the weightiest counts, then the first code. A text without a word
    of any form takes that of a word that abbreviates one, or that one abbreviates,
    unless brands of one form (``evidence``) that show the word speak against it.
    """
    choose = lambda rows: rows.groupBy("clave").agg(F.min_by("forma", F.struct(-F.col("peso"), "forma")).alias("forma"))
    said = texts.select("clave", F.explode("palabras").alias("palabra"))
    direct = cut_lineage(choose(said.join(words, "palabra")))
    rest = texts.join(direct, "clave", "left_anti").select("clave", F.explode("palabras").alias("palabra")).where(F.length("palabra") >= rules.letters)
    known = words.where(F.length("palabra") >= rules.letters).select(F.col("palabra").alias("conocida"), "forma", "peso")
    a, b = F.col("palabra"), F.col("conocida")
    near = rest.select("palabra").distinct().join(known, F.substring(a, 1, 1) == F.substring(b, 1, 1)).where(_abbreviates(a, b, rules.letters) | _abbreviates(b, a, rules.letters))
    seen = evidence.select("forma", "marca", F.explode("palabras").alias("palabra")).groupBy("palabra").agg(F.count_distinct("marca").alias("todas"), F.collect_set("forma").alias("formas"))
    # A word of two brands or more that other forms show too is no word of this form.
    fits = near.join(seen, "palabra", "left").where(F.col("formas").isNull() | (F.array_contains("formas", F.col("forma")) & (F.size("formas") == 1)))
    return direct.unionByName(choose(rest.join(fits.select("palabra", "forma", "peso"), "palabra")))


def described(texts: DataFrame, forms: DataFrame) -> DataFrame:
    """Texts with ``fuerza, contenido, envases``: read by the kind of content of their form, else by that of the text.

    texts: ``clave, fuente, marca, forma, texto, palabras, firma, clase``; forms: ``forma, clase_forma``.
    """
    columns = ["clave", "fuente", "marca", "forma", "texto", "palabras", "firma"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            read = [attributes(t, k) for t, k in zip(batch["texto"], batch["leida"])]
            strength, content, packs = zip(*read) if read else ((),) * 3
            yield batch[columns].assign(fuerza=pd.array(strength, dtype="Float64"), contenido=pd.array(content, dtype="Float64"), envases=packs)

    schema = "clave string, fuente string, marca string, forma string, texto string, palabras array<string>, firma string, fuerza double, contenido double, envases int"
    return texts.join(forms, "forma", "left").select(*columns, F.coalesce("clase_forma", "clase").alias("leida")).mapInPandas(run, schema)


def _without_one(word: Column) -> Column:
    """The word and all words that lack one of its letters."""
    return F.array_distinct(F.concat(F.array(word), F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))))


def _one_slip(a: Column, b: Column) -> Column:
    """True where one letter more, less, other, or two neighbours swapped make ``a`` of ``b``."""
    swapped = F.exists(
        F.sequence(F.lit(1), F.greatest(F.length(b) - 1, F.lit(1))),
        lambda i: a == F.concat(F.substring(b, F.lit(1), i - 1), F.substring(b, i + 1, F.lit(1)), F.substring(b, i, F.lit(1)), F.substring(b, i + 2, F.length(b))),
    )
    return (F.levenshtein(a, b) <= 1) | swapped


def repair_brands(unsolved: DataFrame, solved: DataFrame, phrases: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``clave, marca`` for texts whose brand is mistyped by one slip.

    The slip is in one word of four letters or more, of both the text and the brand;
    the brand's other words stand around it as they are.

    Only words count that are not among the other words of texts with a known
    brand (at least twice there), so that advertising and unit words never pass for
    brands. A slip is found over the words that lack a letter of either side. Of
    several brands one that has the text's form, strength and content in the
    catalogue goes first, then one of its form, then the first in the alphabet.
    """
    common = (
        solved.select("marca", F.explode("palabras").alias("palabra"))
        .where("not array_contains(split(marca, ' '), palabra)")
        .groupBy("palabra")
        .count()
        .where("count >= 2")
        .select("palabra")
    )
    words = unsolved.select("clave", "texto", "forma", "fuerza", "contenido", F.explode("palabras").alias("palabra")).where("length(palabra) >= 4").join(common, "palabra", "left_anti")
    parts = phrases.select("frase", "formas", F.explode(F.array_distinct(F.split("frase", " "))).alias("parte")).where("length(parte) >= 4")
    slips = (
        words.select("palabra").distinct().withColumn("v", F.explode(_without_one(F.col("palabra"))))
        .join(parts.select("parte").distinct().withColumn("v", F.explode(_without_one(F.col("parte")))), "v")
        .select("palabra", "parte")
        .distinct()
        .where(_one_slip(F.col("palabra"), F.col("parte")))
    )
    said = F.concat(F.lit(" "), F.regexp_replace("texto", "[^A-Z]+", " "), F.lit(" "))
    slipped = F.array_join(F.transform(F.split("frase", " "), lambda w: F.when(w == F.col("parte"), F.col("palabra")).otherwise(w)), " ")
    near = words.join(slips.join(parts, "parte"), "palabra").where(F.contains(said, F.concat(F.lit(" "), slipped, F.lit(" "))))
    sold = catalogue.where("marca is not null").select(F.col("marca").alias("frase"), "forma", "fuerza", "contenido").distinct().withColumn("igual", F.lit(True))
    options = near.join(sold, ["frase", "forma", "fuerza", "contenido"], "left")
    rank = F.struct(F.coalesce("igual", F.lit(False)).cast("int").alias("a"), F.coalesce(F.array_contains("formas", F.col("forma")), F.lit(False)).cast("int").alias("b"))
    return options.groupBy("clave").agg(F.max_by("frase", F.struct(rank, F.translate("frase", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ZYXWVUTSRQPONMLKJIHGFEDCBA"))).alias("marca"))


def mined_brands(unsolved: DataFrame, solved: DataFrame, rules: ListingRules = ListingRules()) -> DataFrame:
    """Brands that the catalogue lacks: ``clave, marca`` of texts that hold a recurring unknown word.

    A word is a brand where at least two texts without a known brand have it, and at
    most one text with one for every ten of them. Of several such words one that no
    text with a known brand has goes first, then the one in most texts, then the
    first in the alphabet.
    """
    known = solved.select(F.explode("palabras").alias("palabra")).groupBy("palabra").agg(F.count("*").alias("otros"))
    words = unsolved.select("clave", F.explode("palabras").alias("palabra")).where("length(palabra) >= 4")
    often = words.groupBy("palabra").agg(F.count("*").alias("n")).where("n >= 2").join(known, "palabra", "left").where(F.coalesce("otros", F.lit(0)) <= rules.spread * F.col("n"))
    return words.join(often, "palabra").groupBy("clave").agg(F.min_by("palabra", F.struct((F.coalesce("otros", F.lit(0)) > 0).alias("otros"), (-F.col("n")).alias("n"), "palabra")).alias("marca"))


def _best(hits: DataFrame, phrases: DataFrame, texts: DataFrame) -> DataFrame:
    """``clave, marca``: of the phrases of a text one that comes in its form, then the longest, then the first in the alphabet."""
    told = hits.join(phrases, "frase").join(texts.select("clave", "forma"), "clave")
    fits = F.coalesce(F.array_contains("formas", F.col("forma")), F.lit(False))
    return told.groupBy("clave").agg(F.min_by("frase", F.struct((~fits).alias("a"), (-F.length("frase")).alias("b"), "frase")).alias("marca"))


def products(listings: DataFrame, catalogue: DataFrame, rules: ListingRules = ListingRules()) -> DataFrame:
    """Every record with what tells its product: ``clave, fuente, marca, forma, fuerza, contenido, envases, firma``.

    listings: ``clave, texto``; catalogue: ``clave, texto, marca, laboratorio, molecula,
    forma`` (a code). Records without key or text are left out; repeated keys of one
    table keep the first text in the alphabet. What a text does not say is null; a record
    without a brand stays, with a null one.
    """
    none = F.lit(None).cast("string")
    records = (
        listings.select("clave", "texto", F.lit("anuncio").alias("fuente"), *[none.alias(c) for c in ("marca", "laboratorio", "molecula", "forma")])
        .unionByName(catalogue.select("clave", "texto", F.lit("catalogo").alias("fuente"), "marca", "laboratorio", "molecula", F.col("forma").cast("string")))
        .where("clave is not null and texto is not null")
        .groupBy("clave", "fuente")
        .agg(F.min_by(F.struct("texto", "marca", "laboratorio", "molecula", "forma"), F.struct("texto", "marca", "laboratorio", "molecula", "forma")).alias("x"))
        .select("clave", "fuente", "x.*")
    )
    every = cut_lineage(tokenized(records))
    entries, adverts = every.where("fuente = 'catalogo'"), every.where("fuente = 'anuncio'")
    phrases = cut_lineage(dictionary(entries))
    hits = cut_lineage(find_phrases(adverts, phrases, rules))
    # Texts with one phrase, of a brand sold in one form, show which words go with that form.
    alone = hits.join(phrases.where(F.size("formas") == 1), "frase").groupBy("clave").agg(F.min("frase").alias("marca"), F.max("frase").alias("otra"), F.min(F.col("formas")[0]).alias("forma")).where("marca = otra").drop("otra")
    evidence = adverts.select("clave", "palabras").join(alone, "clave").select("marca", "forma", F.filter("palabras", lambda w: ~F.array_contains(F.split("marca", " "), w)).alias("palabras"))
    words = cut_lineage(form_words(entries, evidence, rules))
    # The catalogue's own codes are trusted.
    told = text_forms(every.where("forma is null"), words, evidence, rules)
    kinds = entries.where("forma is not null").groupBy("forma", "clase").count().groupBy("forma").agg(F.max_by("clase", F.struct("count", "clase")).alias("clase_forma"))
    formed = every.withColumnRenamed("forma", "propia").join(told, "clave", "left").withColumn("forma", F.coalesce("propia", "forma"))
    whole = cut_lineage(described(formed, kinds))
    trusted, texts = whole.where("fuente = 'catalogo'"), whole.where("fuente = 'anuncio'").drop("marca")
    # The catalogue's own brands in the dictionary's spelling.
    short = trusted.select("clave", "marca").where("marca is not null").join(phrases.select(F.col("frase").alias("marca"), F.lit(True).alias("es")), "marca", "left")
    parts = F.split("marca", " ")
    own = short.select("clave", F.when(F.col("es"), F.col("marca")).otherwise(F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(1))), " ")).alias("marca"))
    exact = cut_lineage(_best(hits, phrases, texts))
    solved = texts.join(exact, "clave")
    unsolved = texts.join(exact, "clave", "left_anti")
    repaired = cut_lineage(repair_brands(unsolved, solved, phrases, trusted))
    still = cut_lineage(unsolved.join(repaired, "clave", "left_anti"))
    # The recurring words join the dictionary; what the catalogue's brands left unsolved is searched and repaired with them.
    learned = cut_lineage(still.join(mined_brands(still, solved, rules), "clave").groupBy(F.col("marca").alias("frase")).agg(F.collect_set("forma").alias("formas")))
    held = cut_lineage(_best(find_phrases(still, learned, rules), learned, still))
    mined = still.join(held, "clave")
    mended = repair_brands(still.join(held, "clave", "left_anti"), solved.unionByName(mined), learned, mined)
    brands = exact.select("clave", "marca").unionByName(repaired).unionByName(held).unionByName(mended)
    columns = ["clave", "fuente", "marca", "forma", "fuerza", "contenido", "envases", "firma"]
    return (
        texts.join(brands, "clave", "left").select(columns)
        .unionByName(trusted.drop("marca").join(own, "clave", "left").select(columns))
    )


PRODUCT = ("marca", "forma", "fuerza", "contenido", "envases")


def _identity(found: DataFrame) -> DataFrame:
    """Records with what all records of their product share.

    A record that lacks brand, form, strength or content is of one product only
    with records of the same words and numbers: what is not said is never equal.
    """
    said = F.concat_ws("|", *[F.col(c).cast("string") for c in PRODUCT])
    known = F.lit(True)
    for c in PRODUCT:
        known = known & F.col(c).isNotNull()
    return found.select("clave", F.md5(F.when(known, said).otherwise(F.concat(F.lit("?"), "firma"))).alias("p"))


def groups(found: DataFrame) -> DataFrame:
    """``clave, producto`` of every record: the least key of the product's records stands for it."""
    ids = _identity(found).distinct()
    return ids.join(ids.groupBy("p").agg(F.min("clave").alias("producto")), "p").select("clave", "producto")


def pairs(found: DataFrame) -> DataFrame:
    """All pairs of records of one product: ``clave_a < clave_b``."""
    ids = _identity(found).distinct()
    a, b = ids.withColumnRenamed("clave", "clave_a"), ids.withColumnRenamed("clave", "clave_b")
    return a.join(b, "p").where("clave_a < clave_b").select("clave_a", "clave_b")
