"""Toxicity by weak supervision: many voters, a label model over them, and a linear classifier.

Voters are words of a lexicon, patterns, and words and word stems mined from labelled training rows.
A generative model with a hidden class gives each voter its rate of firing in either class,
the given label being one more noisy voter; voters that fire together beyond what the class
explains share their weight. The posterior classes train a logistic regression, which scores
every text by itself.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import map_rows
from cohortlens.sources.scratch import written

#: Labelled rows the voters and the classifier are fitted on, at most; chosen by hash.
FIT_ROWS = 20_000
#: Mined words and stems, at most; the strongest stay.
MINED = 1000
#: Lengths of stems; words are also mined whole, at any length from two letters.
STEM_SIZES = range(4, 13)
#: Toxic rows a mined form stands in, at least, and how much likelier it is there than in others.
LEAST_ROWS = 4
LEAST_TIMES = 10
#: Numbers of different mined words in a text that are voters of their own.
COUNTS = (1, 2, 3, 4)
THRESHOLD = 0.3
#: How often a given label says toxic in either class, as believed at first, and rows that counts for at least.
GIVEN_RATES = (0.01, 0.95)
GIVEN_ROWS = 100
#: Correlation, given the class, from which voters share their weight.
CORRELATED = 0.5
HELD_OUT = 2

# Words that insult or demean, each a voter of its own.
LEXICON = (
    "idiot idiots moron morons stupid imbecile dumb dumbass fool loser losers scum trash garbage "
    "worthless pathetic disgusting clown jerk bastard bitch asshole shit crap damn hate ugly filthy "
    "vermin parasite retard coward creep freak pig swine rat "
    "dumm idioten arschloch scheisse scheiße dreck abschaum hure schwein "
    "imbécile connard salope merde ordure crétin abruti "
    "estúpido idiota imbécil basura mierda asco puta cabrón inútil"
).split()

PATTERNS = {
    "shouting": lambda text, letters: letters > 20 and sum(map(str.isupper, text)) > 0.5 * letters,
    "exclaiming": lambda text, letters: text.count("!") * 100 > 2 * max(len(text), 150),
    "masked word": lambda text, letters: bool(re.search(r"[^\W\d_]\*{2,}[^\W\d_]?", text)),
    "told off": lambda text, letters: bool(re.search(r"(?i)\b(you are|you're|tu es|du bist|eres) (such )?(an?|une?|ein|so)\b", text)),
}

_WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Voters:
    """Voter numbers by what makes them fire."""

    words: dict[str, list[int]] = field(default_factory=dict)
    stems: dict[str, int] = field(default_factory=dict)
    gates: frozenset[str] = frozenset()
    mined: frozenset[str] = frozenset()
    names: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, forms: Sequence[str]) -> Voters:
        """Voters for the patterns, the lexicon, numbers of different mined words, and mined
        ``forms`` one by one; stems end in ``-``."""
        names = [*PATTERNS, *(f"{n} mined words" for n in COUNTS), *LEXICON, *forms]
        single = len(PATTERNS) + len(COUNTS)
        words: dict[str, list[int]] = {}
        stems: dict[str, int] = {}
        for number, name in enumerate(names[single:], single):
            if name.endswith("-"):
                stems[name[:-1]] = number
            else:
                words.setdefault(name, []).append(number)
        mined = frozenset(f for f in forms if not f.endswith("-"))
        return cls(words, stems, frozenset(s[: STEM_SIZES[0]] for s in stems), mined, names)

    def fire(self, text: str | None) -> list[int]:
        """Numbers of the voters that fire on the whole text, ascending."""
        if not text:
            return []
        found = _WORDS.findall(text.lower())
        letters = sum(map(len, found))
        forms = set(found)
        fired = {number for word in forms & self.words.keys() for number in self.words[word]}
        if self.gates:
            shortest = STEM_SIZES[0]
            for word in forms:
                if word[:shortest] in self.gates:
                    for size in STEM_SIZES[: max(0, len(word) - shortest + 1)]:
                        number = self.stems.get(word[:size])
                        if number is not None:
                            fired.add(number)
        fired.update(i for i, test in enumerate(PATTERNS.values()) if test(text, letters))
        seen = len(forms & self.mined)
        fired.update(i for i, least in enumerate(COUNTS, len(PATTERNS)) if seen >= least)
        return sorted(fired)


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(4)) == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """``(text, toxic)`` of at most ``rows`` labelled documents that are not held out.

    Of copies and most near copies among them one stays, or the words of a text that is
    repeated a thousand times would pass for toxic ones.
    """
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).cast("long").alias("labelled"))
        .agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(rows)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("labelled"), F.col(text_col).alias("text"))

    def make(batch: Iterable[tuple]) -> Iterator[tuple]:
        for text, toxic in batch:
            yield least_shingle(text), text, toxic

    schema = T.StructType(
        [T.StructField("shingle", T.LongType()), T.StructField("text", T.StringType()), T.StructField("toxic", T.IntegerType())]
    )
    labelled = map_rows(texts.join(F.broadcast(known), "labelled").select("text", "toxic"), make, schema)
    first = F.min_by(F.struct("text", "toxic"), F.struct(F.xxhash64("text"), "toxic"))
    return written(labelled.groupBy("shingle").agg(first.alias("row")).select("row.*"), "training")


def least_shingle(text: str | None) -> int:
    """The smallest hash of a text's three-word sequences; copies and most near copies share it."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    sequences = zip(words, words[1:], words[2:]) if len(words) > 2 else [tuple(words)]
    return min(map(xxhash.xxh64_intdigest, map(b" ".join, sequences))) >> 1


def _stems(words: F.Column, size: int) -> F.Column:
    long = F.filter(words, lambda w: F.length(w) >= size)
    return F.transform(long, lambda w: F.concat(F.substring(w, 1, size), F.lit("-")))


def mine_forms(training: DataFrame, limit: int = MINED) -> list[str]:
    """Words, and stems of words (ending in ``-``), that stand in toxic rows far more often.

    Of stems that stand in the same rows because one begins with the other, the shortest stays.
    """
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{2,}"), F.lit(0))
    forms = F.array_distinct(F.flatten(F.array(words, *(_stems(words, size) for size in STEM_SIZES))))
    counted = (
        training.select("toxic", F.explode(forms).alias("form"))
        .groupBy("form")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("c"))
    )
    many, toxic = training.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    toxic = toxic or 0
    clean = many - toxic
    a, c = F.col("a"), F.col("c")
    share = toxic / max(many, 1)
    term = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    ratio = 2 * (
        term(a, (a + c) * share)
        + term(c, (a + c) * (1 - share))
        + term(toxic - a, (many - a - c) * share)
        + term(clean - c, (many - a - c) * (1 - share))
    )
    chosen = (
        counted.filter((a >= LEAST_ROWS) & (a * max(clean, 1) > LEAST_TIMES * c * max(toxic, 1)))
        .orderBy(F.desc(ratio), "form")
        .limit(4 * limit)
        .collect()
    )
    seen = {r["form"]: (r["a"], r["c"]) for r in chosen}
    repeated = lambda form: any(
        seen.get(form[:size] + "-") == seen[form] for size in STEM_SIZES if size < len(form) - 1
    )
    kept = [form for form in seen if not form.endswith("-") or not repeated(form)]
    return sorted(kept[:limit])


def label_model(fires: np.ndarray, given: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior class of each row, and each voter's log-odds when it fires and when not.

    ``fires`` is 0 or 1 by row and voter; ``given`` is the label, the last voter. Expectation
    maximisation from the given labels. Given the class, voters that still agree are
    correlated; a voter's evidence is divided by one plus its strong correlations with others.
    """
    votes = np.column_stack([fires, given]).astype(np.float64)
    posterior = np.where(given > 0, 0.9, 0.1)
    weight = np.ones(votes.shape[1])
    yes = no = np.zeros(votes.shape[1])
    for step in range(rounds):
        ones, zeros = posterior.sum() + 1.0, (1 - posterior).sum() + 1.0
        rate1 = (posterior @ votes + 0.05) / (ones + 0.1)
        rate0 = ((1 - posterior) @ votes + 0.05) / (zeros + 0.1)
        # The hidden class is what the labels mean: what is believed of their errors at first
        # counts as much as the rows, so voters that share a topic cannot become the class.
        rate1[-1] = (posterior @ votes[:, -1] + (ones + GIVEN_ROWS) * GIVEN_RATES[1]) / (2 * ones - 1 + GIVEN_ROWS)
        rate0[-1] = ((1 - posterior) @ votes[:, -1] + (zeros + GIVEN_ROWS) * GIVEN_RATES[0]) / (2 * zeros - 1 + GIVEN_ROWS)
        if step % 5 == 0:
            centred = votes - (posterior[:, None] * rate1 + (1 - posterior)[:, None] * rate0)
            spread = np.sqrt((centred**2).mean(axis=0)) + 1e-9
            agree = (centred / spread).T @ (centred / spread) / len(votes)
            np.fill_diagonal(agree, 0)
            agree[-1] = agree[:, -1] = 0  # the label is no copy of another voter
            weight = 1 / (1 + np.where(agree > CORRELATED, agree, 0).sum(axis=1))
        yes, no = weight * np.log(rate1 / rate0), weight * np.log((1 - rate1) / (1 - rate0))
        logit = math.log(ones / zeros) + votes @ yes + (1 - votes) @ no
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return posterior, yes, no


@dataclass
class Model:
    voters: Voters
    weights: list[float]
    intercept: float

    def score(self, text: str | None) -> float:
        logit = self.intercept + sum(self.weights[i] for i in self.voters.fire(text))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``rows`` labelled rows. Without rows of both classes every lexicon word
    gets one fixed weight and nothing is mined."""
    training = training_rows(docs, labels, id_col, text_col, rows)
    classes = {r["toxic"] for r in training.select("toxic").distinct().collect()}
    if classes != {0, 1}:
        voters = Voters.of([])
        weights = [0.0] * (len(PATTERNS) + len(COUNTS)) + [2.5] * len(LEXICON)
        return Model(voters, weights, -3.0)
    voters = Voters.of(mine_forms(training))

    def make(batch: Iterable[tuple]) -> Iterator[tuple]:
        for text, toxic in batch:
            yield voters.fire(text), toxic

    schema = T.StructType([T.StructField("fired", T.ArrayType(T.IntegerType())), T.StructField("toxic", T.IntegerType())])
    votes = map_rows(training.select("text", "toxic"), make, schema).collect()
    votes.sort(key=lambda r: (r["toxic"], r["fired"]))
    fires = np.zeros((len(votes), len(voters.names)))
    for i, row in enumerate(votes):
        fires[i, row["fired"]] = 1
    posterior, _, _ = label_model(fires, np.array([r["toxic"] for r in votes]))
    size = len(voters.names)
    examples = []
    for row, p in zip(votes, posterior.tolist(), strict=True):
        vector = Vectors.sparse(size, row["fired"], [1.0] * len(row["fired"]))
        examples += [(vector, label, weight) for label, weight in ((1.0, p), (0.0, 1 - p)) if weight > 1e-6]
    session = docs.sparkSession
    frame = session.createDataFrame(examples, ["features", "label", "weight"]).repartition(4).cache()
    fitted = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=100, standardization=False).fit(frame)
    frame.unpersist()
    return Model(voters, [float(w) for w in fitted.coefficients], float(fitted.intercept))


def scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS
) -> DataFrame:
    """One row ``(doc_id, held_out, score, predicted)`` per row of ``docs``, by its text alone.

    Labels come only from rows that are not held out. A null or empty text fires no voter and
    gets the base score. A null id is never held out. Equal texts get equal scores. Label rows
    without a label or a document are left out; several labels of one id are averaged. Other
    columns are not read; an empty table gives an empty table.
    """
    model = fit(docs, labels, id_col, text_col, rows)

    def make(batch: Iterable[tuple]) -> Iterator[tuple]:
        for key, out, text in batch:
            score = model.score(text)
            yield key, out, score, int(score >= THRESHOLD)

    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )
    return map_rows(docs.select(F.col(id_col).cast("long"), held_out(id_col), F.col(text_col)), make, schema)


def not_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns; no shuffle."""
    model = fit(docs, labels, id_col, text_col)
    place = docs.columns.index(text_col)

    def make(batch: Iterable[tuple]) -> Iterator[tuple]:
        for row in batch:
            if model.score(row[place]) < THRESHOLD:
                yield row

    return map_rows(docs, make, docs.schema)
