"""Variant spellings of makers' names (problem 1).

A spelling is taken apart into given name, family words, trade and corporate form. What is a trade and
what a given name is learnt from the spellings themselves: words (or pairs of words) that stand with many
different names, the former behind them, the latter before them. Family words, in every order and
however joined, are looked up in sharded tries with Levenshtein automata (trie join). Spellings of
one trade whose family words lie within two edits are linked if they state the same given name, or
both none; connected components close these links. A group that states an initial or no given name
then joins the only group it can mean, so contradicting given names are never linked through it.
Weaker spellings - without a trade, one family word, a contraction of two, an initial - join the only
maker they can mean; where several or none are possible they stay by themselves.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import permutations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import connected_components
from ..session import drop, materialize, parallelism, table
from .textdist import deletions, osa
from .triejoin import trie_join

#: Edits between the family words of two spellings of one maker.
MOST_EDITS = 2
# Strings that name nobody (compared without case and outer punctuation).
PLACEHOLDERS = frozenset("na|none|null|nil|unknown|not known|unnamed|see letterhead|letterhead|see below|see above|tbd|tba|to be announced|to be determined|not stated|not given|not available|not applicable|various|other|misc|test|xxx|x".split("|"))
# Corporate forms.
FORMS = frozenset("inc incorporated corp corporation co company ltd limited llc plc gmbh ag sa srl bv kg oy ab nv pty lp llp kk spa as".split())
# Trades that are known before any is learnt.
TRADES = (
    "alloys", "aerospace", "automation", "aviation", "batteries", "bearings", "cables", "capacitors", "castings", "ceramics", "chemicals", "coatings", "components", "connectors",
    "controls", "devices", "diagnostics", "dynamics", "electric", "electronics", "engineering", "fasteners", "filters", "foundry", "gears", "glass", "hydraulics", "industries",
    "instruments", "laboratories", "lasers", "lighting", "machinery", "magnetics", "manufacturing", "materials", "metals", "microwave", "motors", "optics", "photonics", "plastics",
    "pneumatics", "polymers", "power systems", "precision", "products", "pumps", "radio", "relay works", "rubber", "semiconductor", "sensors", "software", "solutions", "springs", "steel",
    "switches", "technologies", "tools", "transformers", "valves",
)
# Common short forms of given names.
NICKNAMES = {
    "alexander": "alex sandy alec", "andrew": "andy drew", "anthony": "tony", "barbara": "barb babs", "benjamin": "ben", "catherine": "cathy",
    "charles": "chuck charlie", "christopher": "chris kit", "daniel": "dan danny", "deborah": "deb debbie", "donald": "don", "dorothy": "dot dottie dolly",
    "edward": "ned eddie ed", "elizabeth": "betty liz beth lizzie eliza", "eugene": "gene", "frances": "fran", "francis": "frank", "frederick": "fritz fred freddy",
    "george": "georgie", "gerald": "gerry", "gregory": "greg", "harold": "hal", "henry": "hank harry", "jacqueline": "jackie", "james": "jim jimmy jamie",
    "jennifer": "jenny", "john": "jack johnny", "joseph": "joe", "josephine": "jo josie", "judith": "judy", "katherine": "kate kathy katie kitty", "kenneth": "ken",
    "lawrence": "larry", "leonard": "len lenny leo", "louis": "lou", "margaret": "peggy maggie meg", "matthew": "matt", "michael": "mike mick", "nicholas": "nick",
    "patricia": "trish pat patty", "patrick": "paddy", "peter": "pete", "philip": "phil", "raymond": "ray", "rebecca": "becky", "richard": "dick rick rich",
    "robert": "bob rob bobby", "ronald": "ron", "samuel": "sam", "sarah": "sally", "stephen": "steve", "susan": "sue susie", "theodore": "ted teddy theo",
    "thomas": "tom tommy", "timothy": "tim", "victoria": "vicky", "walter": "walt", "william": "bill will billy willy", "virginia": "ginny", "martha": "patsy",
}
GIVEN = {n: full for full, short in NICKNAMES.items() for n in [full, *short.split()]}
_CAMEL = re.compile(r"([A-Z][a-z]{2,6})([A-Z][a-z]{2,6})")
_LOOK = str.maketrans("01", "ol")
_LINKING = ("and", "the", "und", "et", "y")
SCHEMA = "mfr string, form string, given string, words array<string>, trade string"
#: A word is learnt as a trade or given name from so many spellings and partners, and this share of all spellings, on;
#: no partner may stand in more of its spellings, and it must stand last (first) in half of them.
LEARN_LEAST, LEARN_PARTNERS, LEARN_RATE, MOST_PARTNER, PLACED = 12, 12, 1e-4, 0.25, 0.5
#: Family words of which all orders are looked up; of more, the given and the sorted one.
MOST_ORDERS = 4


class Lexicon:
    """Trades and given names, and what a typed word stands for."""

    def __init__(self, trades=TRADES, given=()):
        self.given = dict(GIVEN) | {g: g for g in given if g not in GIVEN}
        self.given_shorter: dict[str, list[str]] = {}
        for g in sorted({g for g in self.given.values() if len(g) > 4}):
            for d in deletions(g, 2):
                self.given_shorter.setdefault(d, []).append(g)
        self.words: dict[str, str] = {}
        self.by_first: dict[str, list[str]] = {}
        self.shorter: dict[str, list[str]] = {}
        self.memo: dict[str, str | None] = {}
        for t in trades:
            self.add(t)

    def add(self, trade: str) -> None:
        """A trade, unless its words stand for one that is known already."""
        parts = trade.split()
        if len({self.trade_of(w) for w in parts}) == 1 and self.trade_of(parts[0]) or "".join(parts) in self.words:
            return
        for w in parts:
            if w not in self.words:
                self.words[w] = trade
                self.by_first.setdefault(w[0], []).append(w)
                for d in deletions(w, 2) if len(w) >= 6 else ():
                    self.shorter.setdefault(d, []).append(w)
        self.memo.clear()

    def trade_of(self, token: str) -> str | None:
        """The trade a word stands for: written out, in another number, cut short, without vowels, or misspelt."""
        if token not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[token] = self._trade_of(token.replace("-", ""))
        return self.memo[token]

    def _trade_of(self, t: str) -> str | None:
        if len(t) < 3:
            return None
        for w in (t, t + "s", t[:-1] if t.endswith("s") else t):
            if w in self.words:
                return self.words[w]
        stem = t[:-1] if t.endswith("s") and len(t) > 3 else t
        alike = self.by_first.get(t[0], ())
        for w in alike:
            if w.startswith(t) or w.startswith(stem) and len(stem) > 2:
                return self.words[w]
        for w in alike:
            if len(t) <= 5 and len(w) > len(t):
                it = iter(w)
                if all(c in it for c in t) and (w.endswith(t[1:]) or sum(c in "aeiou" for c in t) <= 1 and (len(t) <= 3 or t[-1] == w[-1])):
                    return self.words[w]
        if len(t) >= 6:
            for w in self._near(t, self.shorter, 2):
                if osa(t, w, 2) <= (2 if len(w) >= 8 else 1):
                    return self.words[w]
        return None

    @staticmethod
    def _near(t: str, index: dict[str, list[str]], k: int) -> list[str]:
        """The indexed words that share a string with ``t`` when up to k characters are deleted, in order."""
        return sorted({w for d in deletions(t, k) for w in index.get(d, ())})

    def near_given(self, token: str) -> tuple[int, str | None]:
        """(edits, name) of the nearest long given name within two edits; (3, None) where none is."""
        return min(((osa(token, g, 2), g) for g in self._near(token, self.given_shorter, 2)), default=(3, None))


def parse(name: str | None, lexicon: Lexicon) -> tuple[str, str | None, list[str], str | None] | None:
    """(form, given, family words, trade) of a spelling, or None where it names nobody.

    Forms: full (two family words and more), joined (the family words written as one, or a single word with
    a trade), initial (an initial and one family word), camel (a contraction of two), single (one word).
    """
    if name is None:
        return None
    s = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", name)).strip()
    plain = re.sub(r"[^\w\s]+", "", s).strip().lower()
    if not re.search(r"[^\W\d_]", plain) or plain in PLACEHOLDERS:
        return None
    if m := _CAMEL.fullmatch(s):
        return "camel", None, [m[1].lower(), m[2].lower()], None
    s = re.sub(r"(?<=\w)\.(?=\w)", "", s.casefold()).replace("'", "").replace("’", "")
    found: list[str] = []
    tokens: list[str] = []
    for raw in re.findall(r"[^\W_]+(?:-[^\W_]+)*", s):
        t = lexicon.trade_of(raw) if "-" in raw else None
        if t:
            found.append(t)
            continue
        for x in raw.split("-"):
            x = x.translate(_LOOK) if any(c.isdigit() for c in x) and any(c.isalpha() for c in x) else x
            if x not in _LINKING:
                tokens.append(x)
    core = []
    i = 0
    while i < len(tokens):
        x = tokens[i]
        i += 1
        if x in FORMS and (i > 1 or len(tokens) == 1):
            continue
        if x in lexicon.given or len(x) == 1:
            core.append(x)
            continue
        if i < len(tokens) and x + tokens[i] in lexicon.words:  # a trade written apart
            found.append(lexicon.words[x + tokens[i]])
            i += 1
            continue
        t = lexicon.trade_of(x)
        if t:
            found.append(t)
        else:
            core.append(x)
    trade = found[0] if found else None
    given = None
    for i, x in enumerate(core):
        if x in lexicon.given and len(core) > 1:
            given = lexicon.given[x]
            core.pop(i)
            break
    if given is None and len(core) > 1:
        for i, x in enumerate(core):
            if len(x) == 1:
                given = x
                core.pop(i)
                break
    if given is None and len(core) > 2:
        (edits, g), i = min((lexicon.near_given(x), i) for i, x in enumerate(core))
        if edits <= 2:
            given = g
            core.pop(i)
        elif len(core) == 3 and sum(x in s.rpartition(",")[2] for x in core) == 1 and core[-1] in s.rpartition(",")[2]:  # the name after the comma
            given = "~" + core.pop()
    if not core:
        return ("single", None, [given], trade) if given else None
    if len(core) == 1:
        if given is not None and len(given) == 1:
            return "initial", given, core, trade
        return ("joined" if trade or len(core[0]) > 11 else "single"), given, core, trade
    return "full", given, core, trade


def _parse_batches(lexicon):
    def run(batches):
        for pdf in batches:
            rows = [(m, *p) for m in pdf["mfr"] if (p := parse(m, lexicon.value)) is not None]
            yield pd.DataFrame(rows, columns=["mfr", "form", "given", "words", "trade"], dtype=object)

    return run


def learnt(names: DataFrame) -> Lexicon:
    """The lexicon of distinct spellings (mfr): what is known, and the trades and given names that they show.

    Tokens and neighbouring pairs are counted over all spellings. What is learnt stands in at least
    LEARN_RATE of them, so there are at most a spelling's tokens times 1 / LEARN_RATE such words.
    """
    n_all = names.count()
    least = max(LEARN_LEAST, LEARN_RATE * n_all)
    skip = [*FORMS, *_LINKING, ""]
    tokens = F.filter(F.split(F.lower("mfr"), r"[^\p{L}]+"), lambda t: ~t.isin(skip) & (F.length(t) > 1))
    t = names.select(tokens.alias("t")).filter("size(t) > 1")
    pairs = F.transform(F.sequence(F.lit(1), F.size("t") - 1), lambda i: F.concat_ws(" ", F.element_at("t", i), F.element_at("t", i + 1)))
    unit = t.select("t", F.explode(F.array_distinct(F.concat("t", pairs))).alias("unit"))
    unit = unit.withColumn("own", F.split("unit", " ")).withColumn("last", F.element_at("t", -1) == F.element_at("own", -1)).withColumn("first", F.element_at("t", 1) == F.element_at("own", 1))
    often = materialize(unit.groupBy("unit").agg(F.count("*").alias("n"), F.avg(F.col("last").cast("int")).alias("last"), F.avg(F.col("first").cast("int")).alias("first")).filter(F.col("n") >= least), "often")
    # A unit has at most 1 / LEARN_RATE rows times the tokens of a spelling: pairs with it combine before the shuffle.
    met = unit.join(often.select("unit"), "unit", "left_semi").select("unit", F.explode(F.array_except("t", "own")).alias("partner")).groupBy("unit", "partner").agg(F.count("*").alias("m"))
    top = met.groupBy("unit").agg(F.max("m").alias("top"), F.count("*").alias("partners"))
    found = often.join(top, "unit").filter((F.col("top") <= MOST_PARTNER * F.col("n")) & (F.col("partners") >= LEARN_PARTNERS)).orderBy(F.desc("n"), "unit").collect()
    known = set(GIVEN)
    lexicon = Lexicon(given=[r["unit"] for r in found if r["first"] >= PLACED and r["last"] < PLACED and " " not in r["unit"]])
    for r in found:
        if r["last"] >= PLACED and not known & set(r["unit"].split()):
            lexicon.add(r["unit"])
    drop(often)
    return lexicon


@F.pandas_udf(T.ArrayType(T.StringType()))
def _orders_udf(words: pd.Series) -> pd.Series:
    """The words written as one in every order."""
    return words.map(lambda w: sorted({"".join(p) for p in permutations(w)} if len(w) <= MOST_ORDERS else {"".join(w), "".join(sorted(w))}))


def _same_given(a: str, b: str):
    """Given names that are equal, both absent, or - where one is in no list - one edit apart."""
    x, y = F.col(a), F.col(b)
    unlisted = (x.startswith("~") | y.startswith("~")) & (F.length(x) > 4) & (F.levenshtein(F.ltrim(x, F.lit("~")), F.ltrim(y, F.lit("~")), 1) >= 0)
    return x.eqNullSafe(y) | F.coalesce(unlisted, F.lit(False))


def _only(may: DataFrame, key: str, to: str) -> DataFrame:
    """(key, to) of the keys that have one candidate."""
    return may.groupBy(key).agg(F.min(to).alias(to), F.max(to).alias("_another")).filter(F.col(to) == F.col("_another")).select(key, to)


def _joined_groups(cores: DataFrame, links: DataFrame) -> DataFrame:
    """(core, maker): groups that state an initial or no given name join the only group they can mean.

    ``cores``: (core, given), ``links``: (core, to) between groups of one trade with near family words, either way.
    First groups with an initial join one with a name, then groups without join what is left.
    """
    rank = lambda c: F.when(F.col(c).isNull(), 0).when(F.length(c) == 1, 1).otherwise(2)
    kind = cores.select("core", "given", rank("given").alias("rank"))
    l = links.join(kind, "core").join(kind.select(F.col("core").alias("to"), F.col("given").alias("to_given"), F.col("rank").alias("to_rank")), "to")  # noqa: E741
    up = materialize(l.filter("to_rank > rank AND (given IS NULL OR left(ltrim('~', to_given), 1) = given)").select("core", "rank", "to").distinct(), "up")
    initial = _only(up.filter("rank = 1"), "core", "to").withColumnRenamed("to", "maker")
    bare = up.filter("rank = 0").join(initial.select(F.col("core").alias("to"), F.col("maker").alias("via")), "to", "left").select("core", F.coalesce("via", "to").alias("maker"))
    return kind.select("core").join(initial.unionByName(_only(bare, "core", "maker")), "core", "left").select("core", F.coalesce("maker", "core").alias("maker"))


def link_names(names: DataFrame) -> DataFrame:
    """(mfr, maker) for each distinct spelling in ``names`` (mfr) that names somebody.

    ``maker`` is an arbitrary but fixed key shared by the spellings of one maker. Nulls and placeholders
    are left out; a spelling that matches no other has a maker of its own.
    """
    spark = names.sparkSession
    distinct = materialize(names.select("mfr").filter("mfr IS NOT NULL").distinct(), "spellings")
    lexicon = spark.sparkContext.broadcast(learnt(distinct))
    pid = F.md5(F.concat_ws("\x1f", "form", F.coalesce("given", F.lit("-")), F.concat_ws(" ", "words"), F.coalesce("trade", F.lit("-"))))
    parsed = materialize(distinct.repartition(parallelism(spark)).mapInPandas(_parse_batches(lexicon), SCHEMA).withColumn("pid", pid), "parsed")
    profiles = materialize(parsed.drop("mfr").dropDuplicates(["pid"]).withColumn("k", F.concat_ws("", "words")), "profiles")
    keyed = profiles.filter("form IN ('full', 'joined')")
    orders = materialize(keyed.withColumn("e", F.explode(_orders_udf("words"))).select("pid", "e", "given", "trade"), "orders")
    whole = keyed.select(F.col("k").alias("q")).distinct()
    near = trie_join(whole, orders.select("e").distinct(), MOST_EDITS)
    near = materialize(near.select("q", "e").unionByName(whole.select("q", F.col("q").alias("e"))), "near")
    asked = keyed.select(F.col("pid").alias("a"), F.col("k").alias("q"), F.col("given").alias("ga"), F.col("trade").alias("ta"))
    met = asked.join(near, "q").join(orders.select(F.col("pid").alias("b"), "e", F.col("given").alias("gb"), F.col("trade").alias("tb")), "e")
    met = materialize(met.filter("a <> b AND (ta IS NULL OR tb IS NULL OR ta = tb)").select("a", "b", "ga", "gb", "ta", "tb").distinct(), "met")
    # Makers: spellings with a trade.
    same = met.filter(F.col("ta") == F.col("tb"))
    closed = connected_components(same.filter(_same_given("ga", "gb")).select("a", "b"))
    core = keyed.filter("trade IS NOT NULL").join(closed.withColumnRenamed("node", "pid"), "pid", "left").select("pid", "given", F.coalesce("component", "pid").alias("core"))
    core = materialize(core, "cores")
    ends = core.select("pid", "core")
    links = same.filter(~_same_given("ga", "gb")).select("a", "b").join(ends.select(F.col("pid").alias("a"), "core"), "a").join(ends.select(F.col("pid").alias("b"), F.col("core").alias("to")), "b").filter("core <> to").select("core", "to").distinct()
    makers = _joined_groups(core.groupBy("core").agg(F.min("given").alias("given")), links)
    sure = materialize(core.join(makers, "core").select("pid", "maker"), "makers")
    # Spellings that leave something out: every maker each could mean, the nearest family words (at most one edit) first.
    known = profiles.join(sure, "pid")
    words = materialize(known.filter("form = 'full'").select("maker", "trade", "words").distinct(), "words")
    maker_of = sure.withColumnRenamed("pid", "other")
    bare = met.filter("ta IS NULL AND tb IS NOT NULL").select(F.col("a").alias("pid"), F.col("b").alias("other"), F.col("ga").alias("mine"), F.col("gb").alias("theirs"))
    bare = bare.unionByName(met.filter("tb IS NULL AND ta IS NOT NULL").select(F.col("b").alias("pid"), F.col("a").alias("other"), F.col("gb").alias("mine"), F.col("ga").alias("theirs")))
    stated = (F.length("mine") == 1) | (F.length("theirs") == 1)
    fits = F.col("mine").isNull() | F.col("theirs").isNull() | _same_given("mine", "theirs") | (stated & (F.left("mine", F.lit(1)) == F.left("theirs", F.lit(1))))
    bare = bare.filter(fits).join(maker_of, "other").select("pid", "maker").distinct()
    weak = profiles.filter("form IN ('single', 'initial')").select("pid", "form", F.col("given").alias("i"), F.element_at("words", 1).alias("q"), F.col("trade").alias("t"))
    held = words.select("maker", "trade", "words", F.posexplode("words").alias("at", "e"))
    alone, family = weak.select("q").distinct(), held.select("e").distinct()
    shorter = trie_join(alone, family, 1)  # the longer one of two strings asks for the shorter
    longer = trie_join(family.withColumnRenamed("e", "q"), alone.withColumnRenamed("q", "e"), 1).select(F.col("e").alias("q"), F.col("q").alias("e"), "d")
    spelt = shorter.unionByName(longer).filter("length(q) > 3").unionByName(alone.join(family, F.col("q") == F.col("e")).select("q", "e", F.lit(0).alias("d"))).distinct()
    spelt = weak.join(spelt, "q")
    one = spelt.join(held, "e").filter("form = 'single' AND at = 0 OR form = 'initial' AND at > 0 AND left(words[0], 1) = i AND (t IS NULL OR t = trade)")
    one = materialize(one.select("pid", "maker", "d").distinct(), "one")
    one = one.join(one.groupBy("pid").agg(F.min("d").alias("d")), ["pid", "d"], "left_semi").select("pid", "maker")
    camel = profiles.filter("form = 'camel'").select("pid", F.col("words")[0].alias("c1"), F.col("words")[1].alias("c2"), F.left(F.col("words")[0], F.lit(3)).alias("p1"), F.left(F.col("words")[1], F.lit(3)).alias("p2"))
    camel = camel.join(words.filter("size(words) = 2").select("maker", F.col("words")[0].alias("w1"), F.col("words")[1].alias("w2"), F.left(F.col("words")[0], F.lit(3)).alias("p1"), F.left(F.col("words")[1], F.lit(3)).alias("p2")), ["p1", "p2"]).filter("startswith(w1, c1) AND startswith(w2, c2)").select("pid", "maker")
    may = materialize(bare.unionByName(one).unionByName(camel), "may")
    placed = sure.unionByName(_only(may, "pid", "maker"))
    # What is left without any maker: spellings without a trade that are near each other.
    loose = met.filter("ta IS NULL AND tb IS NULL").filter(_same_given("ga", "gb")).select("a", "b").join(may.select(F.col("pid").alias("a")).distinct(), "a", "left_anti").join(may.select(F.col("pid").alias("b")).distinct(), "b", "left_anti")
    rest = connected_components(loose).select(F.col("node").alias("pid"), F.col("component").alias("maker"))
    placed = placed.unionByName(rest)
    drop(distinct, near, orders)
    return parsed.select("mfr", "pid").join(placed, "pid", "left").select("mfr", F.coalesce("maker", "pid").alias("maker"))


#: A maker's spellings are paired in blocks of so many, so no task holds all pairs of one maker.
BLOCK = 500


def spelling_pairs(linked: DataFrame) -> DataFrame:
    """(mfr_a, mfr_b), mfr_a < mfr_b: all pairs of spellings of one maker."""
    blocks = linked.groupBy("maker").agg(F.count("*").alias("n")).filter("n > 1").select("maker", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    sized = linked.join(blocks, "maker")
    left = sized.select(F.col("mfr").alias("mfr_a"), "maker", F.expr("pmod(xxhash64(mfr), blocks)").alias("block"))
    right = sized.select(F.col("mfr").alias("mfr_b"), "maker", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"))
    return left.join(right, ["maker", "block"]).filter("mfr_a < mfr_b").select("mfr_a", "mfr_b")


def typed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "notice_headers").select("mfr").unionByName(table(spark, sf_dir, "written_headers").select("mfr"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of different strings that name the same maker."""
    return spelling_pairs(materialize(link_names(typed_names(spark, sf_dir)), "linked"))


def p1_makers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each spelling with its maker and the number of the maker's spellings."""
    linked = materialize(link_names(typed_names(spark, sf_dir)), "linked")
    return linked.join(linked.groupBy("maker").agg(F.count("*").alias("spellings")), "maker").select("mfr", "maker", "spellings")


QUERIES = {"p1_found": p1_found, "p1_makers": p1_makers}
