"""Toxicity by a lexicon that misspelled terms match too, and by the context that they stand in.

The lexicon is a short list of terms and what labelled rows add to it: words and
word beginnings (stems) that toxic documents have significantly oftener. It is a
trie; a Levenshtein automaton is intersected with it, states being sets of trie
nodes with the edits spent, made when first met. So a word is looked up in one
pass over its letters, which mostly ends after a few. A window of words around a
match tells quotation (quotation marks, verbs of saying) from abuse (words of address).
A term counts by how far it exceeds what clean text of that length has of it. A
logistic model of direct and quoted weights and of the text's length (the same uses say less in a long
text), fitted to the same rows, gives the score.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import kept, saved
from sluice.llm.simhash import MULTIPLIERS

#: Plain insults of the four languages that the tables are in; labels add what else is used.
TERMS = tuple("""
idiot idiots idiotic moron morons stupid dumb dumbass imbecile loser losers pathetic worthless trash garbage scum vermin
disgusting clown bastard bitch asshole fucker fucking shithead bullshit retard retarded cretin jackass douchebag slut whore
idiote imbécile connard connasse salope ordure débile abruti crétin minable
idiotin dummkopf arschloch schlampe wichser abschaum hurensohn schwachkopf versager
idiota estúpido estúpida imbécil gilipollas cabrón puta basura escoria pendejo
""".split())
SAYING = frozenset("""
said says say wrote writes write quoted quotes called calls word words term phrase reported
dit disait écrit écrivait appelé mot terme sagte sagt schrieb schreibt nannte wort begriff
dijo dice escribió escribe llamó palabra término
""".split())
ADDRESS = frozenset("you your you're youre u tu toi vous votre ton ta du dich dir ihr euch eres te ti usted tú".split())
OPENING, CLOSING = "\"'“‘„«‹", "\"'”’“»›"
LETTERS = str.maketrans("013457@$!", "oieastasi")
#: Coefficients before any row is seen: base, direct use, quoted use, length.
PRIOR_WEIGHT, PRIOR = 4.0, np.array([-3.5, 1.2, 0.1, 0.0])
TOP_WEIGHT, MOST_WEIGHT = 8.0, 16.0


def bare(word: str) -> str:
    """Lower case, without the marks around it."""
    return word.lower().strip(".,;:?!\"'()[]{}“”‘’„«»")


def plain(word: str) -> str:
    """Bare and without accents; digits and signs that stand for letters replaced, other signs dropped, long runs of a letter cut to one."""
    word = unicodedata.normalize("NFKD", bare(word)).translate(LETTERS)
    word = "".join(c for c in word if c.isalnum())
    return re.sub(r"(.)\1\1+", r"\1", word)


def edits_for(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


class Automaton:
    """A trie of terms, intersected with Levenshtein automata (with swaps of neighbours) as words come.

    terms: term -> weight, for plain words; exact: weights of bare words (=word) and of
    what bare words begin with (^stem), without edits. clean: plain words that don't count
    as misspellings.
    """

    def __init__(self, terms: dict[str, float], exact: dict[str, float], clean: frozenset[str] = frozenset()) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.room = [0]  # the most edits that a term below takes
        self.terms, self.exact, self.clean = {plain(t): w for t, w in terms.items() if plain(t)}, exact, clean
        self.lengths = sorted({len(x) - 1 for x in exact if x[0] == "^"}, reverse=True)
        for word in self.terms:
            at, room = 0, edits_for(len(word))
            self.room[0] = max(self.room[0], room)
            for c in word:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.room.append(0)
                at = self.children[at][c]
                self.room[at] = max(self.room[at], room)
            self.term[at] = word
        self.forget()

    def forget(self) -> None:
        """Lets go of all states; they are made again when met."""
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.found: list[tuple[int, str] | None] = []
        self.start = self.state({(0, 0, "")})

    def state(self, items: set[tuple[int, int, str]]) -> int:
        """Items are (node, edits, letter that a swap still needs); dropped letters need no input."""
        todo = list(items)
        while todo:
            at, spent, swap = todo.pop()
            if not swap:
                for down in self.children[at].values():
                    if spent < self.room[down] and (down, spent + 1, "") not in items:
                        items.add((down, spent + 1, ""))
                        todo.append((down, spent + 1, ""))
        least: dict[tuple[int, str], int] = {}
        for at, spent, swap in items:
            least[at, swap] = min(spent, least.get((at, swap), spent))
        key = frozenset((at, spent, swap) for (at, swap), spent in least.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.next.append({})
            ended = [(spent, self.term[at]) for at, spent, swap in key if not swap and self.term[at] and spent <= edits_for(len(self.term[at]))]
            self.found.append(min(ended, default=None))
        return self.states[key]

    def step(self, state: int, letter: str) -> int:
        items = set()
        for at, spent, swap in self.sets[state]:
            if swap:
                if letter == swap:
                    items.add((at, spent, ""))
                continue
            if letter in self.children[at]:
                items.add((self.children[at][letter], spent, ""))
            if spent < self.room[at]:
                items.add((at, spent + 1, ""))  # one letter too many
            for c, down in self.children[at].items():
                if spent < self.room[down]:
                    items.add((down, spent + 1, ""))  # another letter
                    if letter in self.children[down] and letter != c and spent < self.room[self.children[down][letter]]:
                        items.add((self.children[down][letter], spent + 1, c))
        self.next[state][letter] = to = self.state(items) if items else -1
        return to

    def match(self, word: str) -> tuple[str, float] | None:
        """The nearest term or else the exact word or longest stem of a word, and its weight; two edits count half, one counts 0.8."""
        at, form = self.start, plain(word)
        for letter in form:
            to = self.next[at].get(letter)
            at = self.step(at, letter) if to is None else to
            if at < 0:
                break
        if at >= 0 and self.found[at] and (not self.found[at][0] or form not in self.clean):
            spent, term = self.found[at]
            return term, self.terms[term] * (1.0, 0.8, 0.5)[spent]
        form = bare(word)
        marks = [f"={form}", *(f"^{form[:n]}" for n in self.lengths if len(form) > n)]
        return next(((m, self.exact[m]) for m in marks if m in self.exact), None)


def quotation(words: list[str], at: int, reach: int = 8) -> float:
    """0 for plain abuse to 1 for a quotation, by the words around."""
    before, after = words[max(0, at - reach) : at + 1], words[at : at + 1 + reach]
    opened = max((i for i, w in enumerate(before) if w[0] in OPENING), default=-1)
    quoted = opened >= 0 and not any(w[-1] in CLOSING or w.rstrip(".,;:?!")[-1:] in CLOSING and w.rstrip(".,;:?!") for w in before[opened:-1]) and any(w.rstrip(".,;:?!")[-1:] and w.rstrip(".,;:?!")[-1:] in CLOSING for w in after)
    near = {w.lower().strip(".,;:?!\"'“”‘’„«»") for w in (*before[:-1], *after[1:])}
    score = 0.7 * quoted + 0.3 * bool(near & SAYING)
    return score * (0.5 if near & ADDRESS else 1.0)


class Scorer:
    """Finds the matches in texts; what it has learnt about words stays with the Python worker.

    rates: how often clean text has a term, =word or ^stem, by word. keep, states: how many words without and with a match, and how many states of
    the automaton, a worker holds before it begins anew, which costs time and changes no result.
    """

    def __init__(self, terms: dict[str, float], exact: dict[str, float], clean: frozenset[str] = frozenset(), rates: dict[str, float] | None = None, keep: int = 300_000, states: int = 50_000) -> None:
        self.name, self.terms, self.exact, self.clean, self.rates, self.keep, self.states = uuid.uuid4().hex, terms, exact, clean, rates or {}, keep, states

    def matches(self, texts: pa.Array, step_bytes: int = 4 << 20) -> Iterator[tuple[int, list[tuple[str, float, float, str]]]]:
        """Of each text (null: empty) how many words it has; term, =word or ^stem, weight, quotation and plain word of each match."""
        automaton, clear, hits = kept(("scorer", self.name), lambda: (Automaton(self.terms, self.exact, self.clean), set(), {}))
        size, at = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy()), 0
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + step_bytes, "right")))
            lists = pc.utf8_split_whitespace(pc.fill_null(texts.slice(at, upto - at), ""))
            flat = lists.flatten()
            coded = flat.dictionary_encode()
            words = coded.dictionary.to_pylist()
            for known in (clear, hits):
                if len(known) > self.keep:
                    known.clear()
            if len(automaton.sets) > self.states:
                automaton.forget()
            for word in words:
                if word not in clear and word not in hits:
                    found = automaton.match(word)
                    if found:
                        hits[word] = found
                    else:
                        clear.add(word)
            hot = np.fromiter((w in hits for w in words), bool, len(words))
            places = np.flatnonzero(hot[coded.indices.to_numpy()])
            edges = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
            bounds = np.searchsorted(places, edges).tolist()
            filled = np.r_[0, np.cumsum(pc.binary_length(flat).to_numpy() > 0)]  # blanks at a text's ends leave empty words
            for i in range(upto - at):
                found, low, high = [], int(edges[i]), int(edges[i + 1])
                for place in places[bounds[i] : bounds[i + 1]].tolist():
                    start = max(low, place - 16)
                    around = flat.slice(start, min(high, place + 17) - start).to_pylist()
                    pairs = [(j, w) for j, w in enumerate(around) if w]
                    term, weight = hits[around[place - start]]
                    found.append((term, weight, quotation([w for _, w in pairs], next(k for k, (j, _) in enumerate(pairs) if j == place - start)), plain(around[place - start])))
                yield int(filled[high] - filled[low]), found
            at = upto


    def features(self, n: int, found: list[tuple[str, float, float, str]]) -> tuple[float, float, float]:
        """Weights of direct and of quoted use, each up to MOST_WEIGHT, and the logarithm of the length in words."""
        direct: dict[str, list[float]] = {}
        quoted = 0.0
        for term, weight, quote, _ in found:
            uses = direct.setdefault(term, [0.0, 0.0])
            uses[0] += 1 - quote
            uses[1] = max(uses[1], weight)
            quoted += weight * quote
        usual = {t: self.rates.get(t, 0.0) * n for t in direct}
        return min(MOST_WEIGHT, sum(w * max(0.0, k - usual[t] - 1.5 * math.sqrt(usual[t])) for t, (k, w) in direct.items())), min(MOST_WEIGHT, quoted), math.log1p(n / 100)


def fitted(x: np.ndarray, y: np.ndarray, pull: float = 1.0, rounds: int = 100) -> np.ndarray:
    """Logistic coefficients by damped Newton steps, drawn to PRIOR: what they are without rows."""
    x = np.column_stack([np.ones(len(x)), x]) if len(x) else np.empty((0, len(PRIOR)))

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((np.logaddexp(0, z) - y * z).sum() + pull / 2 * ((b - PRIOR) ** 2).sum())

    b, now = PRIOR.copy(), loss(PRIOR)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + pull * np.eye(len(PRIOR)), x.T @ (y - p) - pull * (b - PRIOR))
        while (then := loss(b + step)) > now and np.abs(step).max() > 1e-10:
            step = step / 2
        b, gain, now = b + step, now - then, then
        if gain < 1e-9:
            break
    return b


class Model:
    def __init__(self, scorer: Scorer, coefficients: np.ndarray) -> None:
        self.scorer, self.coefficients = scorer, coefficients

    def scores(self, texts: pa.Array) -> Iterator[float]:
        b0, *b = self.coefficients.tolist()
        for n, found in self.scorer.matches(texts):
            z = b0 + sum(x * y for x, y in zip(b, self.scorer.features(n, found), strict=True))
            yield 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


BANDS, ROWS = 5, 3


def bands(text: str, shingle: int = 5) -> list[bytes]:
    """BANDS keys of ROWS MinHash values each of a text's shingles of so many words; copies share most of them, unlike texts none."""
    words = text.lower().encode().split()
    grams = {b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))}
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams), np.uint64, len(grams))
    least = np.array([((hashes * m) ^ ((hashes * m) >> np.uint64(32))).min() for m in MULTIPLIERS[: BANDS * ROWS]], np.uint64)
    return [row.tobytes() for row in least.reshape(BANDS, ROWS)]


def without_copies(rows: DataFrame) -> DataFrame:
    """text, y without near copies of one label: band by band, of the rows that share the band's key the one with the least hash stays."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [bands(t or "") for t in batch.column(0).to_pylist()]
            yield pa.record_batch([*batch.columns, *(pa.array([k[i] for k in keys], pa.binary()) for i in range(BANDS))], names=["text", "y", *names])

    names = [f"k{i}" for i in range(BANDS)]
    rows = saved(rows.mapInArrow(marked, f"text string, y int, {', '.join(f'{n} binary' for n in names)}").withColumn("h", F.xxhash64("text")), "labelled")
    left = rows.select("y", "h", *names)
    for n in names:
        left = left.groupBy("y", n).agg(F.min(F.struct("h", *(m for m in names if m != n))).alias("row")).select("y", n, "row.*")
    kept = rows.join(left.select("y", "h"), ["y", "h"], "left_semi").groupBy("y", "h").agg(F.first("text").alias("text")).select("text", "y")
    return saved(kept, "distinct")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 20_000) -> Model:
    """A model from the labels given (the caller leaves out what is held out).

    max_rows bounds the labelled rows that take part, by least hash of their ids. From these
    the lexicon gets every word and stem of three toxic rows or more whose evidence is over 14 (by chance alone
    about one in 10^6 has that), and all words of clean rows that are near a term are known not to be misspellings of it. Of rows with one label whose
    five-word shingles share the three MinHash values of one of five bands one takes part: copies
    would pass for so many proofs. Labels other than 0
    and 1 don't count; of an id's labels the greatest does. Without labels the model is
    the prior one over TERMS.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(max_rows)  # bounded, so it may be broadcast
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(known), "__id").select("text", "y")

    rows = without_copies(rows)
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    sums = {r.y: (r.n, r.words) for r in rows.groupBy("y").agg(F.count("*").alias("n"), F.sum(F.size(F.split("text", r"\s+"))).alias("words")).collect()}
    (toxic, _), (clear, clear_words) = sums.get(1, (0, 0)), sums.get(0, (0, 0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list[int]] = {}
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                here: Counter = Counter()
                for raw, n in Counter((text or "").split()).items():
                    word = bare(raw)
                    if word:
                        here[f"={word}"] += n
                        for k in (4, 5, 6):
                            if len(word) > k:
                                here[f"^{word[:k]}"] += n
                for key, n in here.items():
                    row = got.setdefault(key, [0, 0, 0, 0])
                    row[y] += 1
                    row[2 + y] += n
        keys = list(got)
        for i in range(0, len(keys), 50_000):
            part = keys[i : i + 50_000]
            yield pa.record_batch([pa.array(part, pa.string()), *map(pa.array, np.array([got[k] for k in part], np.int64).T.copy())], names=["term", "b", "a", "uses_b", "uses_a"])

    terms, exact, rates = dict.fromkeys(TERMS, PRIOR_WEIGHT), {}, {}
    if toxic and clear:
        counts = rows.mapInArrow(count, "term string, b long, a long, uses_b long, uses_a long").groupBy("term").agg(*(F.sum(c).alias(c) for c in ("a", "b", "uses_a", "uses_b")))
        weight = F.log(F.lit(float(clear + 1) / (toxic + 1)) * (F.col("uses_a") + 0.5) / (F.col("uses_b") + 0.5))
        # were the term no oftener in toxic rows, a of a + b so would have a chance of about exp(-evidence)
        share, base = F.col("a") / (F.col("a") + F.col("b")), toxic / (toxic + clear)
        evidence = (F.col("a") + F.col("b")) * (share * F.log(share / base) + (1 - share) * F.log(F.greatest(1 - share, F.lit(1e-9)) / (1 - base)))
        kept = counts.where("a >= 3").withColumns({"w": weight, "e": evidence}).where("w > 1.5 and e > 14")
        used: dict[str, int] = {}
        stems: list[str] = []
        for r in kept.orderBy(F.desc(F.col("e") * F.when(F.col("term").startswith("="), 1.0).otherwise(0.97)), "term").collect():
            stem, word = r.term[0] == "^", r.term[1:]
            if any(word.startswith(x) or stem and x.startswith(word) for x in stems) or stem and sum(n for x, n in used.items() if x.startswith(word)) > 0.8 * r.uses_a:
                continue  # another entry has it
            name = plain(word) if not stem and plain(word) == word else r.term
            (exact if name == r.term else terms)[name] = min(TOP_WEIGHT, r.w)
            rates[name] = r.uses_b / max(1, clear_words)
            if stem:
                stems.append(word)
            else:
                used[word] = r.uses_a

    first = spark.sparkContext.broadcast(Scorer(terms, exact))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: Counter = Counter()
        for batch in batches:
            for (_, found), y in zip(first.value.matches(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                if not y:
                    got.update({w for t, _, _, w in found if w != t and t[0] not in "=^"})
        yield pa.record_batch([pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())], names=["word", "n"])

    # words of clean rows that are near a term: no misspellings of it
    clean = frozenset(r.word for r in rows.mapInArrow(seen, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect())
    scorer = Scorer(terms, exact, clean, rates)
    second = spark.sparkContext.broadcast(scorer)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([second.value.features(n, f) for n, f in second.value.matches(batch.column(0))]).reshape(-1, len(PRIOR) - 1)
            yield pa.record_batch([*(pa.array(c.copy()) for c in x.T), batch.column(1)], names=["x", "q", "n", "y"])

    points = np.array([(r.x, r.q, r.n, r.y) for r in rows.mapInArrow(measure, "x double, q double, n double, y int").collect()]).reshape(-1, len(PRIOR))  # max_rows at most
    points = points[np.lexsort(points.T)]
    return Model(scorer, fitted(points[:, :-1], points[:, -1]))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "toxicity") -> DataFrame:
    """All rows and columns of docs with the score, 0 to 1; null and empty texts score as texts without any match. A column of docs named score_col gives way."""
    docs = docs.drop(score_col)
    known = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([*batch.columns, pa.array(list(known.value.scores(batch.column(place))), pa.float64())], names=[*batch.schema.names, score_col])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{kinds + ', ' if kinds else ''}`{score_col}` double")


def held_out(id_col: str = "doc_id"):
    """Whether a row's labels are kept from learning: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
