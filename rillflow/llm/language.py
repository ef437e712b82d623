"""Language identification with spans for mixed texts.

For every language, counts of character n-grams in words are gathered from all labelled
documents, and how many of its letters are of each script. A word's script leaves only the
languages that use it; among these a character model (n-grams of three characters, backing off
to two and one) scores the word. The Viterbi path through the words of a text, with a penalty
for switching, labels each word, and so gives the spans; the text's language is the one with
the most letters. Running sums tell which texts are of one language throughout, and need no
path search; for the others it runs through all their blocks of words at once.

Counts are exact: an n-gram is its characters, 21 bits each, and a stored table has the counts
by language of each. The distinct 3-grams of all texts are scored once, by joins with it, and a
chunk of documents gets the scores of its distinct 3-grams by another join; rows equal in id and text
are in one chunk. What reaches the driver is the number of letters of each language, by script.

Rows: a null text, or one without letters, is ``und`` with score 0 and no spans; null labels
teach nothing, and a document without an id is neither held out nor learned from; repeated rows
are labelled alike; equal scores go to the language first in the alphabet; without any label
every text is ``und``; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.arrowtext import slices
from rillflow.llm.common import stored
from rillflow.llm.letters import Distinct, distinct, letter_words

#: First code points of ranges that each belong to one script (or to signs between scripts).
SCRIPTS = np.array([0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0700, 0x0900, 0x0980, 0x0A00, 0x0B00, 0x0C00, 0x0D00,
                    0x0E00, 0x0E80, 0x0F00, 0x1000, 0x10A0, 0x1100, 0x1200, 0x1400, 0x1780, 0x1E00, 0x1F00, 0x2000, 0x2E80,
                    0x3040, 0x30A0, 0x3100, 0x3130, 0x3400, 0xA000, 0xAC00, 0xD800, 0xF900, 0xFB1D, 0x20000])
#: Ranges that continue the script of another one: Latin, Greek, kana, Hangul, Han, Arabic.
SAME = {22: 0, 23: 1, 27: 26, 29: 18, 32: 18, 30: 25, 34: 25, 36: 25, 35: 5}

#: A letter's chance without context has half a letter seen for each of 2^BITS.
BITS = 14
#: Characters of text of a chunk of documents that are scored at once.
CHUNK_CHARS = 2 << 20
#: A language uses a script that at least this share of its letters is in.
LEAST_SHARE = 0.01
#: Log-likelihood that a switch costs; and that a word costs in a script its language lacks.
SWITCH = 12.0
NO_SCRIPT = 50.0


def script_of(chars: np.ndarray) -> np.ndarray:
    own = np.arange(len(SCRIPTS))
    for k, v in SAME.items():
        own[k] = v
    return own[np.searchsorted(SCRIPTS, chars, side="right") - 1]


def _grams(d: Distinct, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, n-gram) of every n-gram inside a distinct word and its end marks: the characters'
    code points plus 1, 21 bits each, the last one lowest."""
    chars = d.chars.astype(np.int64) + 1
    n = max(0, len(chars) - size + 1)
    out = np.zeros(n, np.int64)
    for j in range(size):
        out = out << 21 | chars[j:j + n]
    word = np.repeat(np.arange(len(d.first) - 1), np.diff(d.first))[:n]
    inside = np.arange(n) + size <= d.first[1:][word]
    return word[inside], out[inside]


def counts_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of 1 to 3 characters in the words and how often each occurs; and -1 - s with
    the number of letters for each script s."""
    w, _ = letter_words(texts)
    d = distinct(w, before=2)
    times = np.bincount(d.of_word, minlength=len(d.first) - 1)
    real = d.chars > 0
    word = np.repeat(np.arange(len(d.first) - 1), np.diff(d.first))[real]
    parts = [*(_grams(d, n) for n in (1, 2, 3)), (word, -1 - script_of(d.chars[real]))]
    gram, which = np.unique(np.concatenate([g for _, g in parts]), return_inverse=True)
    return gram, np.bincount(which, np.concatenate([times[word] for word, _ in parts]), minlength=len(gram)).astype(np.int64)


class Model:
    """The languages, which scripts they use, their numbers of 1-grams, and the stored table of
    ``gram`` and ``n``, the counts by language."""

    def __init__(self, grams: DataFrame | None, letters: dict[str, np.ndarray], totals: dict[str, int]):
        self.langs = sorted(letters)
        self.grams = grams
        self.totals = [totals[x] for x in self.langs]
        share = np.array([letters[x] for x in self.langs]).reshape(len(self.langs), len(SCRIPTS))
        self.uses = share >= LEAST_SHARE * np.maximum(share.sum(axis=1, keepdims=True), 1)

    def triple_scores(self, triples: DataFrame) -> DataFrame:
        """``gram, score`` of the distinct 3-grams ``triples``: by language the log-likelihood of the
        last character behind the two before, whether a language has the 3-gram or not."""
        k = len(self.langs)
        none = F.array(*[F.lit(0).cast("bigint")] * k)
        pairs = triples.select(F.expr("explode(array(gram & 4398046511103L, shiftright(gram, 21))) AS gram")).distinct()
        ones = pairs.select(F.expr("explode(array(gram & 2097151L, shiftright(gram, 21))) AS gram")).distinct()
        counted = lambda df: df.join(self.grams, "gram", "left").withColumn("n", F.coalesce("n", none))
        totals = F.array(*[F.lit(float(t) + 0.5 * (1 << BITS)) for t in self.totals])
        smoothed = lambda n, less, before: F.zip_with(
            F.zip_with(n, less, lambda x, y: x + 2 * y), before, lambda x, y: x / (y + 2))

        def longer(grams: DataFrame, mask: int, shorter: DataFrame) -> DataFrame:
            end = shorter.select(F.col("gram").alias("end"), F.col("p").alias("end_p"))
            before = shorter.select(F.col("gram").alias("before"), F.col("n").alias("before_n"))
            return counted(grams).withColumns({"end": F.expr(f"gram & {mask}L"), "before": F.expr("shiftright(gram, 21)")}) \
                .join(end, "end").join(before, "before").select("gram", "n", smoothed(F.col("n"), F.col("end_p"), F.col("before_n")).alias("p"))

        one = stored(counted(ones).withColumn("p", F.zip_with("n", totals, lambda x, t: (x + 0.5) / t)), "language_ones")
        two = stored(longer(pairs, (1 << 21) - 1, one), "language_pairs")
        return longer(triples, (1 << 42) - 1, two).select("gram", F.transform("p", lambda x: F.log(x).cast("float")).alias("score"))


def word_scores(d: Distinct, known: np.ndarray, scores: np.ndarray, uses: np.ndarray) -> np.ndarray:
    """Log-likelihood of each distinct word (with two zeros before and one behind) by language, from the
    sorted 3-grams ``known`` and their ``scores``; ``uses`` is which scripts the languages use."""
    n = len(d.first) - 1
    word, gram = _grams(d, 3)
    at = np.searchsorted(known, gram)
    out = np.stack([np.bincount(word, scores[at, j], minlength=n) for j in range(len(uses))], axis=1)
    if n:
        use = uses[:, script_of(d.chars[d.first[:-1] + 2])].T
        out = np.where(use.any(axis=1, keepdims=True), out - NO_SCRIPT * ~use, 0.0)
    return out


def _arrays(table: pa.Table, key: str, value: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys in order, and for each its list of ``k`` numbers."""
    keys = table.column(key).to_numpy()
    lists = table.column(value).combine_chunks()
    order = np.argsort(keys)
    return keys[order], lists.flatten().to_numpy(zero_copy_only=False).reshape(len(keys), k)[order]


#: Words of a block: the path search runs through all blocks of all texts at once.
BLOCK = 64


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The best labels of the words of texts, none of them empty (text d has the words first[d]
    to first[d + 1]).

    Texts are cut into blocks. For all blocks at once, word by word, the best score from each
    label before a block to each label at its end is found; these are chained through each text,
    which fixes the labels at the blocks' ends; then the labels inside, again for all blocks.
    """
    k = scores.shape[1]
    lens = np.diff(first)
    n_blocks = -(-lens // BLOCK)
    head = np.cumsum(n_blocks) - n_blocks  # each text's first block
    text = np.repeat(np.arange(len(lens)), n_blocks)
    start = first[:-1][text] + (np.arange(len(text)) - head[text]) * BLOCK
    size = np.minimum(first[1:][text] - start, BLOCK)
    by_size = np.argsort(-size, kind="stable")
    active = [int(np.searchsorted(-size[by_size], -t, side="left")) for t in range(BLOCK)]  # blocks longer than t

    def through(x: np.ndarray, back: np.ndarray | None = None) -> np.ndarray:
        """Best scores at the end of the blocks from those before them, (blocks, ..., labels)."""
        for t in range(BLOCK):
            at = by_size[:active[t]]
            if not len(at):
                break
            now = x[at]
            moved = now.max(axis=-1, keepdims=True) - switch
            if back is not None:
                back[at, t] = np.where(now >= moved, np.arange(k), now.argmax(axis=-1)[..., None])
            word = scores[start[at] + t]
            x[at] = np.maximum(now, moved) + (word if x.ndim == 2 else word[:, None, :])
        return x

    across = through(np.broadcast_to(np.where(np.eye(k, dtype=bool), 0.0, -np.inf), (len(text), k, k)).copy())
    order = np.argsort(-n_blocks, kind="stable")
    best = np.zeros((len(lens), k))
    before = np.empty((len(text), k))  # best scores before each block
    for t in range(int(n_blocks.max(initial=0))):
        d = order[:int(np.searchsorted(-n_blocks[order], -t, side="left"))]
        before[head[d] + t] = best[d]
        best[d] = (best[d][:, :, None] + across[head[d] + t]).max(axis=1)
    end = np.empty(len(text), np.int64)
    enter = np.empty(len(text), np.int64)
    label = best.argmax(axis=1)
    for t in range(int(n_blocks.max(initial=0)) - 1, -1, -1):
        d = order[:int(np.searchsorted(-n_blocks[order], -t, side="left"))]
        b = head[d] + t
        end[b] = label[d]
        enter[b] = label[d] = (before[b] + across[b, :, label[d]]).argmax(axis=1)
    # inside: from the label before a block, any label for a text's first one
    x = np.where(np.arange(k) == enter[:, None], 0.0, -np.inf)
    x[head] = 0.0
    back = np.zeros((len(text), BLOCK, k), np.int8 if k < 128 else np.int32)
    through(x, back)
    out = np.empty(len(scores), np.int32)
    for t in range(BLOCK - 1, -1, -1):
        b = np.flatnonzero(size > t)
        out[start[b] + t] = end[b]
        end[b] = back[b, t, end[b]]
    return out


def label_words(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Labels of the words of many texts (text d has the words first[d] to first[d + 1]): those
    of a best path, being the text's best single language wherever that is one.

    It is if no run of words gains ``switch`` or more by another language, and the best run
    from the beginning and the best one to the end gain no more than that together.
    """
    n, k = scores.shape
    lens = np.diff(first)
    text = np.repeat(np.arange(len(lens)), lens)
    sums = np.zeros((n + 1, k))
    np.cumsum(scores, axis=0, out=sums[1:])
    whole = (sums[first[1:]] - sums[first[:-1]]).argmax(axis=1) if k else np.zeros(len(lens), np.int64)
    label = whole[text].astype(np.int32)
    if k < 2 or not n:
        return label
    gain = scores - scores[np.arange(n), label][:, None]
    upto = np.zeros((n + 1, k))
    np.cumsum(gain, axis=0, out=upto[1:])
    start = upto[:-1] - upto[first[:-1]][text]  # sums before each word, within its text
    after = start + gain
    step = np.abs(start).max() + np.abs(gain).max() + 1
    low = np.minimum.accumulate(start - text[:, None] * 2 * step, axis=0) + text[:, None] * 2 * step
    some = np.flatnonzero(lens)
    heads = first[:-1][some]
    most = np.maximum.reduceat((after - low).max(axis=1), heads)
    begin = np.maximum(np.maximum.reduceat(after.max(axis=1), heads), 0)
    whole_sum = (upto[first[1:]] - upto[first[:-1]])[text]
    finish = np.maximum(np.maximum.reduceat((whole_sum - start).max(axis=1), heads), 0)
    search = some[(most >= switch) | (begin + finish > switch)]
    if len(search):
        words = np.flatnonzero(np.isin(text, search))
        ends = np.concatenate([[0], np.cumsum(lens[search])])
        label[words] = viterbi(scores[words], ends, switch)
    return label


def learn(docs: DataFrame) -> Model:
    """The model of all of ``docs`` (text, lang) with a label. What reaches the driver is at most 37
    letter counts and a total for each language, however many documents there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                langs = np.array(part.column("lang").to_pylist(), object)
                for lang in sorted(set(langs)):
                    gram, n = counts_of(part.column("text").filter(pa.array(langs == lang)))
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)],
                                                     names=["lang", "gram", "n"])

    counted = docs.filter("lang IS NOT NULL").select("text", "lang").mapInArrow(run, "lang string, gram bigint, n bigint")
    counted = stored(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language_counts")
    letters: dict[str, np.ndarray] = {}
    for r in counted.filter("gram < 0").collect():
        letters.setdefault(r.lang, np.zeros(len(SCRIPTS)))[-1 - r.gram] = r.n
    totals = {r.lang: r.n for r in counted.filter(f"gram BETWEEN 0 AND {(1 << 21) - 1}").groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(letters)
    if not langs:
        return Model(None, {}, {})
    by_lang = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
    grams = counted.filter("gram >= 0").groupBy("gram").agg(by_lang.alias("of"))
    n = F.array(*[F.coalesce(F.try_element_at("of", F.lit(x)), F.lit(0).cast("bigint")) for x in langs])
    return Model(stored(grams.select("gram", n.alias("n")), "language_grams"), letters, totals)


def _triples(part: pa.RecordBatch) -> np.ndarray:
    """The distinct 3-grams of the rows' words."""
    return np.unique(_grams(distinct(letter_words(part.column("text"))[0], before=2), 3)[1])


def distinct_triples(docs: DataFrame) -> DataFrame:
    """``gram`` of the distinct 3-grams of all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([pa.array(_triples(part))], names=["gram"])

    return docs.select("text").mapInArrow(run, "gram bigint").distinct()


SPANS = "array<struct<start:int,end:int,lang:string>>"


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, lang_pred, score (the share of the letters that are in
    words of that language) and spans: runs of words of one language, by characters."""
    names = [*model.langs, "und"]
    none = k = len(model.langs)
    uses = model.uses

    def labelled(part: pa.RecordBatch, known: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
        """The rows' results by the scores of the 3-grams ``known``."""
        w, off = letter_words(part.column("text"))
        n = part.num_rows
        text, lens = w.of_text(), w.ends - w.starts
        if k:
            d = distinct(w, before=2)
            label = label_words(word_scores(d, known, scores, uses)[d.of_word], w.first, switch)
        else:
            label = np.zeros(len(text), np.int32)
        letters = np.bincount(text * (k + 1) + label, lens, minlength=n * (k + 1)).reshape(n, k + 1)
        total = letters.sum(axis=1)
        best = np.where((total > 0) & (k > 0), letters[:, :max(k, 1)].argmax(axis=1), none)
        score = np.where(best < none, letters[np.arange(n), np.minimum(best, k)] / np.maximum(total, 1), 0.0)
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (label[1:] != label[:-1])
        heads = np.flatnonzero(new) if k else np.zeros(0, np.int64)
        tails = np.append(heads[1:], len(text))[:len(heads)] - 1
        of = text[heads]
        spans = pa.StructArray.from_arrays([
            pa.array((w.starts[heads] - off[of]).astype(np.int32)), pa.array((w.ends[tails] - off[of]).astype(np.int32)),
            pa.array([names[x] for x in label[heads]], pa.string())], names=["start", "end", "lang"])
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)).astype(np.int32)), spans)
        return pa.RecordBatch.from_arrays([
            part.column("doc_id"), pa.array([names[x] for x in best], pa.string()), pa.array(score), lists],
            names=["doc_id", "lang_pred", "score", "spans"])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield labelled(part, np.zeros(0, np.int64), np.zeros((0, 0)))

    def asked(table: pa.Table) -> pa.Table:
        grams = np.unique(np.concatenate([_triples(part) for b in table.to_batches() for part in slices(b)]))
        return pa.table({"chunk": np.full(len(grams), table.column("chunk")[0].as_py(), np.int64), "gram": grams})

    def answered(table: pa.Table, answers: pa.Table) -> pa.Table:
        known, scores = _arrays(answers, "gram", "score", k)
        return pa.Table.from_batches([labelled(part, known, scores) for b in table.to_batches() for part in slices(b)])

    schema = f"doc_id bigint, lang_pred string, score double, spans {SPANS}"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not k:
        return docs.mapInArrow(alone, schema)
    scores = stored(model.triple_scores(stored(distinct_triples(docs), "language_triples")), "language_scores")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chars // CHUNK_CHARS + 1)))
    answers = docs.groupBy("chunk").applyInArrow(asked, "chunk bigint, gram bigint").join(scores, "gram").select("chunk", "gram", "score")
    return docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(answered, schema)


def held_out(column: str = "doc_id"):
    """Whether a document is kept from the model, by the checksum of its id; null without one."""
    return F.crc32(F.col(column).cast("string")) % 4 == 2


def op7_language(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = learn(docs.filter(~held_out()))
    out = identify(docs, model)
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
