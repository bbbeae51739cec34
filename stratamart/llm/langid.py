"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text recognises everything that occurs in that text.
A document is parsed against each automaton into the longest phrases that it recognises. A phrase
costs as many bits as it takes to point into the labelled text, so the language with the fewest
phrases, normalised by the size of its text, describes the document best.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.arrow_text import runs
from stratamart.llm.common import seeded_key

# The labelled sample, the only bounded thing here: documents per language, characters of each, and bytes of all
# automata together; many languages or letters get shorter samples, so that the bound holds.
SAMPLE_DOCS = 200
SAMPLE_CHARS = 300
MODEL_BYTES = 16 << 20
# Letters with a symbol of their own; further ones share some.
OWN_SYMBOLS = 120
SHARED_SYMBOLS = 64
# Symbols that are parsed in one go, and characters that are held at once.
SEGMENT = 256
CHUNK = 1 << 18
UNKNOWN = "und"
BLANK, FOREIGN = 0, 1
FOUND = "lang_pred string, score double, bits double, letters long, phrases long"
# A text with this many letters in a known language has so many letters a phrase at least.
ENOUGH_LETTERS = 16
LEAST_PHRASE = 2


@dataclass(frozen=True)
class Model:
    langs: list[str]
    symbols: np.ndarray  # code point -> symbol, uint8
    steps: np.ndarray  # place + symbol -> 2 * next place + 1 if a phrase ends, int32
    roots: np.ndarray  # first place per language
    bits: np.ndarray  # of a phrase, per language


def automaton(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence, state 0 being the root."""
    moves: list[dict[int, int]] = [{}]
    length, link = [0], [-1]
    last = 0
    for symbol in symbols.tolist():
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in moves[state]:
            moves[state][symbol] = new
            state = link[state]
        if state >= 0:
            to = moves[state][symbol]
            if length[to] == length[state] + 1:
                link[new] = to
            else:
                twin = len(moves)
                moves.append(dict(moves[to]))
                length.append(length[state] + 1)
                link.append(link[to])
                link[to] = link[new] = twin
                while state >= 0 and moves[state].get(symbol) == to:
                    moves[state][symbol] = twin
                    state = link[state]
        last = new
    return moves


def symbol_table(texts: list[str]) -> tuple[np.ndarray, int]:
    """A symbol for every code point, and their number: letters by their lower case, anything else
    blank. Letters that no text has are foreign."""
    counts = Counter(c for t in texts for c in t.lower() if c.isalpha())
    known = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
    symbol = {c: FOREIGN + 1 + i for i, c in enumerate(known[:OWN_SYMBOLS])}
    base = FOREIGN + 1 + len(symbol)
    symbol |= {c: base + ord(c) % SHARED_SYMBOLS for c in known[OWN_SYMBOLS:]}
    table = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if char.isalpha():
            table[code] = symbol.get(char.lower(), FOREIGN)
    return table, base + (SHARED_SYMBOLS if len(known) > OWN_SYMBOLS else 0)


def as_symbols(joined: str, table: np.ndarray) -> np.ndarray:
    return table[np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)]


def single_blanks(symbols: np.ndarray) -> np.ndarray:
    """Which symbols stay when runs of blanks become one blank and leading ones none."""
    before = np.concatenate([[BLANK], symbols[:-1]])
    return (symbols != BLANK) | (before != BLANK)


def compile_model(samples: dict[str, str]) -> Model:
    """Automata as one table of steps. A missing step ends the phrase, and the symbol begins the next;
    a symbol that the language does not have ends a phrase each time."""
    langs = sorted(samples)
    table, width = symbol_table([samples[n] for n in langs])
    width += width % 2  # places are multiples of the width; their lowest bit marks the end of a phrase
    most = max(1_000, MODEL_BYTES // (max(1, len(langs)) * 8 * width))
    parts, roots, bits, at = [], [], [], 0
    for lang in langs:
        symbols = as_symbols(samples[lang], table)
        symbols = symbols[single_blanks(symbols)][:most]
        moves = automaton(symbols)
        root = np.full(width, at + 1, dtype=np.int32)
        for symbol, to in moves[0].items():
            root[symbol] = at + to * width + 1
        steps = np.tile(root, (len(moves), 1))
        for state, own in enumerate(moves):
            for symbol, to in own.items():
                steps[state, symbol] = at + to * width
        parts.append(steps.reshape(-1))
        roots.append(at)
        bits.append(np.log2(max(2, len(symbols))))
        at += steps.size
    return Model(langs, table, np.concatenate([*parts, np.zeros(0, np.int32)]), np.array(roots), np.array(bits))


def phrases(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases per text and language, and letters per text. Each SEGMENT symbols of a text are
    parsed for themselves, all segments of all texts and languages in step."""
    symbols = as_symbols("\n".join(texts) + "\n", model.symbols)
    lengths = np.array([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    keep = single_blanks(symbols)
    symbols, owner = symbols[keep], owner[keep]
    letters = np.bincount(owner, weights=symbols != BLANK, minlength=len(texts))
    sizes = np.bincount(owner, minlength=len(texts))
    segments = -(-sizes // SEGMENT)
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lane = np.repeat(np.cumsum(segments) - segments, sizes) + place // SEGMENT
    filled = np.bincount(lane, minlength=int(segments.sum()))
    order = np.argsort(-filled, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    columns = np.zeros((SEGMENT, len(order)), dtype=np.int32)
    columns[place % SEGMENT, rank[lane]] = symbols
    active = np.searchsorted(-filled[order], -np.arange(SEGMENT), "left")
    state = np.tile(model.roots.astype(np.int32), (len(order), 1))
    ends = np.zeros(state.shape, dtype=np.int32)
    for step in range(SEGMENT):
        n = active[step]
        if not n:
            break
        to = model.steps[state[:n] + columns[step, :n, None]]
        ends[:n] += to & 1
        state[:n] = to & ~1
    of_lane = np.repeat(np.arange(len(texts)), segments)[order]
    counts = np.zeros((len(texts), len(model.langs)))
    np.add.at(counts, of_lane, ends + 1)
    return counts, letters


def predict(model: Model, texts: list[str | None]) -> pd.DataFrame:
    """FOUND per text. Texts are cut into chunks of CHUNK characters, whose phrases are added up."""
    chunks, owner = [], []
    for i, text in enumerate(texts):
        for at in range(0, len(text or ""), CHUNK):
            chunks.append(text[at : at + CHUNK])
            owner.append(i)
    counts = np.zeros((len(texts), len(model.langs)))
    letters = np.zeros(len(texts))
    low = 0
    while low < len(chunks):
        high, held = low, 0
        while high < len(chunks) and (high == low or held + len(chunks[high]) <= CHUNK):
            held += len(chunks[high])
            high += 1
        own, own_letters = phrases(model, chunks[low:high])
        np.add.at(counts, owner[low:high], own)
        np.add.at(letters, owner[low:high], own_letters)
        low = high
    out = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "bits": 0.0}, index=range(len(texts)))
    out["letters"], out["phrases"] = letters.astype(np.int64), np.int64(0)
    found = np.flatnonzero(letters > 0)
    if len(model.langs) and len(found):
        cost = counts[found] * model.bits
        best = cost.argmin(axis=1)
        out.loc[found, "phrases"] = counts[found, best].astype(np.int64)
        least = cost[np.arange(len(found)), best]
        cost[np.arange(len(found)), best] = np.inf
        second = cost.min(axis=1)
        out.loc[found, "lang_pred"] = np.array(model.langs, dtype=object)[best]
        out.loc[found, "score"] = 1 - least / second
        out.loc[found, "bits"] = least / letters[found]
    return out


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """A model from labelled rows: for each language the first SAMPLE_CHARS characters of the
    SAMPLE_DOCS documents that a seeded shuffle puts first. Null labels and texts take no part."""
    first = Window.partitionBy("lang").orderBy("order", "text")
    rows = (
        docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
        .select(
            F.col(lang).cast("string").alias("lang"),
            F.substring(text, 1, SAMPLE_CHARS).alias("text"),
            seeded_key(F.col(key), "languages-1").alias("order"),
        )
        .withColumn("n", F.row_number().over(first))
        .filter(F.col("n") <= SAMPLE_DOCS)
        .collect()
    )
    held: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["n"])):
        held.setdefault(row["lang"], []).append(row["text"])
    return compile_model({n: "\n".join(t) for n, t in held.items()})


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``bits``, ``letters``, ``phrases`` (which replace
    columns so named).

    ``lang_pred``: the learned language with the cheapest parse, ties to the first by name; ``und``
    where the text is null or has no letter, or no language was learned. ``score``: what share of the
    second-best cost the best one saves, 0 for ties and ``und``, 1 if only one language was learned.
    ``bits``: the cost per letter; ``letters`` and ``phrases``: their numbers. Whole texts are parsed; no column but the text is looked at.
    """
    # Plain values: the workers need no class of ours to unpack them.
    sent = docs.sparkSession.sparkContext.broadcast(tuple(getattr(model, f.name) for f in fields(model)))

    @F.arrow_udf(FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*sent.value)
        kinds = {"lang_pred": pa.string(), "score": pa.float64(), "bits": pa.float64(), "letters": pa.int64(), "phrases": pa.int64()}
        for texts in batches:
            parts = [predict(own, run["text"].to_pylist()) for run in runs(pa.record_batch({"text": texts}), most=4 * CHUNK)]
            rows = pd.concat(parts) if parts else pd.DataFrame(columns=list(kinds))
            yield pa.StructArray.from_arrays([pa.array(rows[n], kind) for n, kind in kinds.items()], names=list(kinds))

    # Or else Spark would copy it into a filter on its result, and parse every text twice.
    found = found.asNondeterministic()
    held = [c for c in docs.columns if c not in ("lang_pred", "score", "bits", "letters", "phrases")]
    return docs.select(*held, found(F.col(text)).alias("__found")).select(*held, "__found.*")


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def recognised(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """The documents that are in one of the languages of ``docs``, with their language: where ``lang`` is null it is
    the predicted one, else it stays, as all other columns do.

    Rejected are texts without letters, null ones among them, and those of ENOUGH_LETTERS letters or more whose best
    parse has fewer than LEAST_PHRASE letters a phrase: no language knows more of them than single letters and pairs.
    Shorter texts say too little to be rejected. Repeated rows are judged alike; without labelled rows there is no
    language, and all are rejected. An empty table stays empty.
    """
    model = train(docs.filter(~held_out(key)), text, lang, key)
    found = identify(docs.withColumn("__lang", F.col(lang)), model, text)
    foreign = (F.col("letters") >= ENOUGH_LETTERS) & (F.col("letters") < LEAST_PHRASE * F.col("phrases"))
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & ~foreign)
    return kept.select(*(F.coalesce("__lang", F.col("lang_pred").cast(docs.schema[c].dataType)).alias(c) if c == lang else c for c in docs.columns))
