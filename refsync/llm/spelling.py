"""Spelling variant grouping: words of a corpus that differ by one letter, found in a trie of letter-group counts.

Every word is the vector of how many letters it has of each group. One inserted letter adds one to one count, one deleted
letter takes one away, a replaced letter does both or neither; so words that are one edit apart have vectors with a surplus
of at most one and a deficit of at most one. Words are arranged by successive counts: level i of the trie branches by the
count of group i. A search goes down with the counts of its word and may spend the surplus and the deficit once each, on
its way to leaves whose words are then verified letter by letter. Blocks of searches are worked depth first, the deepest
block of a stack next, so what is held is bounded by the depth.

The trie is dealt out by its first levels: a word is kept where the counts of those groups say and sent, as a search, to
each place its budget can reach. An edit is found from one end only: searches look for words that are not longer and, among
words of equal length, smaller. A vocabulary over `WIDE` words is dealt out by more levels (same result, smaller places).

Counting reads whole texts: runs of letters `[A-Za-z\\u00C0-\\u00FF]+`, A-Z lower-cased, combined before the shuffle. In one
of 199 runs of a document (by crc32 of id and run) one letter is left out, which plants misspellings.

Defined results: null and empty texts have no words; runs of a row with a null id are never changed; repeated rows count
again; ties between equally frequent near words go to the smallest in code-point order. An empty table gives no words.
Other columns of the input are not looked at. Words of any length are handled; those over `LONG` letters are verified one
by one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.sources.storage import stage

PLANTED = 199
LEAST_LETTERS, LEAST_COUNT, DOMINANCE = 6, 5, 5
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")
_FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
#: Letters of a text that are split into runs together, and words a task holds before it passes them on.
BLOCK_LETTERS = 1 << 20
HELD_WORDS = 1 << 20
#: Letter groups: a word's letters by code modulo GROUPS. Levels the trie is dealt out by, for few and for many words.
GROUPS = 14
DEALT_LEVELS, WIDE_LEVELS, WIDE = 3, 6, 4_000_000
LONG = 64
#: Searches of a block, and words and searches of one trie at most unless one place has more.
BLOCK = 1 << 15
TRIE_WORDS = 1 << 18


def blocks(text: str) -> Iterator[str]:
    """A long text in blocks that end where no letter stands."""
    begin = 0
    while len(text) - begin > BLOCK_LETTERS:
        gap = _BREAK.search(text, begin + BLOCK_LETTERS)
        if gap is None:
            break
        yield text[begin : gap.end()]
        begin = gap.end()
    yield text[begin:]


def words_of(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one document, with the planted misspellings."""
    for block in blocks(text):
        for run, n in Counter(LETTERS.findall(block.translate(_FOLD))).items():
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % PLANTED == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= LEAST_LETTERS:
                yield run, n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()

    def rows() -> Iterator[pa.RecordBatch]:
        words = list(total)
        for i in range(0, len(words), 1 << 16):
            part = words[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([total[w] for w in part], pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for word, n in words_of(doc_id, text.as_py() or ""):
                total[word] += n
            if len(total) >= HELD_WORDS:
                yield from rows()
                total.clear()
    yield from rows()


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur often enough."""
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    counts = own.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least_count)


def one_edit_apart(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced letter makes one word the other."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    short, long_ = sorted((a, b), key=len)
    head = next((i for i in range(len(short)) if short[i] != long_[i]), len(short))
    return short[head + (len(short) == len(long_)) :] == long_[head + 1 :]


class Words:
    """Words as letter codes, aligned to the left and to the right, with their letter-group counts."""

    def __init__(self, words: list[str]):
        self.words = words
        raw = [w.encode("latin-1") for w in words]
        self.size = np.array([len(w) for w in raw], np.int64)
        width = int(min(self.size.max(initial=0), LONG))
        self.left = np.zeros((len(raw), width), np.uint8)
        self.right = np.zeros((len(raw), width), np.uint8)
        self.counts = np.zeros((len(raw), GROUPS), np.int64)
        letters = np.frombuffer(b"".join(raw), np.uint8)
        of = np.repeat(np.arange(len(raw)), self.size)
        np.add.at(self.counts, (of, letters % GROUPS), 1)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        fits = place < width
        self.left[of[fits], place[fits]] = letters[fits]
        back = self.size[of] - 1 - place
        fits = back < width
        self.right[of[fits], back[fits]] = letters[fits]

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of words are one edit apart: what they share at both ends leaves one letter."""
        longer = np.maximum(self.size[a], self.size[b])
        shorter = np.minimum(self.size[a], self.size[b])

        def shared(side: np.ndarray) -> np.ndarray:
            unlike = side[a] != side[b]
            return np.where(unlike.any(1), unlike.argmax(1), side.shape[1]) if side.shape[1] else np.zeros(len(a), np.int64)

        ends = np.minimum(shared(self.left), shorter) + np.minimum(shared(self.right), shorter)
        found = (longer - shorter <= 1) & (ends >= longer - 1) & (longer <= LONG)
        for i in np.flatnonzero(longer > LONG):
            found[i] = one_edit_apart(self.words[a[i]], self.words[b[i]])
        return found


class Trie:
    """Words arranged by successive letter-group counts. A node is a range of the words in that order."""

    def __init__(self, words: Words, kept: np.ndarray, prefix: np.ndarray):
        """`kept`: which words are in it; `prefix`: place in the dealt trie of each, above the counts."""
        counts = words.counts[kept]
        order = np.lexsort([*counts.T[::-1], prefix])
        self.kept = kept[order]
        self.words = words
        node = _ranks(prefix[order])
        self.roots, self.keys, self.children = np.unique(prefix), [], []
        for level in range(GROUPS):
            key = node << 32 | counts[order, level]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            self.keys.append(key[new])
            node = np.cumsum(new) - 1
        self.leaf_start = np.append(np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])), len(node))

    def search(self, query: np.ndarray, prefix: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, near word) pairs for queries at their places, each edit once: found words are shorter or smaller."""
        counts, size = self.words.counts, self.words.size
        root = np.minimum(np.searchsorted(self.roots, prefix), len(self.roots) - 1)
        here = np.flatnonzero(self.roots[root] == prefix)
        stack = [(0, query[part], root[part], np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)) for part in _parts(here)]
        while stack:
            level, word, node, more, less = stack.pop()
            if level == GROUPS:
                yield from self._leaves(word, node)
                continue
            step_word, step_node, step_more, step_less = [], [], [], []
            for change in (-1, 0, 1):
                wanted = counts[word, level] + change
                allowed = (more + (change > 0) <= 1) & (less + (change < 0) <= 1) & (wanted >= 0)
                key = node << 32 | wanted
                at = np.minimum(np.searchsorted(self.keys[level], key), len(self.keys[level]) - 1)
                go = np.flatnonzero(allowed & (self.keys[level][at] == key))
                step_word.append(word[go])
                step_node.append(at[go])
                step_more.append(more[go] + (change > 0))
                step_less.append(less[go] + (change < 0))
            new = [np.concatenate(x) for x in (step_word, step_node, step_more, step_less)]
            stack += [(level + 1, *[x[part] for x in new]) for part in _parts(np.arange(len(new[0])))]
        del size

    def _leaves(self, word: np.ndarray, node: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n = self.leaf_start[node + 1] - self.leaf_start[node]
        ends = np.cumsum(n)
        for part in _parts(np.arange(len(word)), ends):
            m = n[part]
            inner = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            found = self.kept[np.repeat(self.leaf_start[node[part]], m) + inner]
            own = np.repeat(word[part], m)
            size = self.words.size
            one_way = (size[found] < size[own]) | ((size[found] == size[own]) & (found < own))
            own, found = own[one_way], found[one_way]
            good = self.words.near(own, found)
            yield own[good], found[good]


def _ranks(ordered: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))


def _parts(rows: np.ndarray, weight: np.ndarray | None = None) -> list[np.ndarray]:
    """Rows in blocks of about BLOCK, by number or by running weight."""
    if weight is None:
        return [rows[i : i + BLOCK] for i in range(0, len(rows), BLOCK)]
    return np.split(rows, np.searchsorted(weight, np.arange(BLOCK, int(weight[-1]) if len(weight) else 0, BLOCK))) if len(rows) else []


def _changes(levels: int) -> np.ndarray:
    """Changes of the first counts that the budget allows."""
    unit = np.eye(levels, dtype=np.int64)
    return np.concatenate([np.zeros((1, levels), np.int64), unit, -unit, *[unit[[i]] - np.delete(unit, i, 0) for i in range(levels)]])


def _places(counts: np.ndarray) -> np.ndarray:
    """One number for the first counts of a word (counts over 1023 share their numbers, which only merges places)."""
    place = np.zeros(len(counts), np.int64)
    for column in counts.T:
        place = place << 10 | np.minimum(column, 1023)
    return place


def _dealt(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """Every word where it is kept and, as a search, where its budget leads."""
    changes = _changes(levels)
    for batch in batches:
        words = batch.column(0).to_pylist()
        counts = Words(words).counts[:, :levels]
        for i in range(0, len(words), 1 << 12):
            own = counts[i : i + (1 << 12)]
            reached = own[:, None] + changes
            rows, which = np.nonzero((reached >= 0).all(2))
            place = np.concatenate([_places(own), _places(reached[rows, which])])
            row = np.concatenate([np.arange(len(own)), rows]) + i
            kept = np.arange(len(row)) < len(own)
            columns = [pa.array(place), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, ["place", "word", "n", "kept"])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of a partition in order of places; places are put together until a trie has TRIE_WORDS rows."""

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        encoded = table["word"].combine_chunks().dictionary_encode()
        ordered = np.argsort(np.array(encoded.dictionary.to_pylist(), object), kind="stable")  # by code points
        rank = np.empty(len(ordered), np.int64)
        rank[ordered] = np.arange(len(ordered))
        names = encoded.dictionary.take(pa.array(ordered))
        code = rank[encoded.indices.to_numpy()]
        n = np.zeros(len(ordered), np.int64)
        n[code] = table["n"].to_numpy()
        words = Words(names.to_pylist())
        place, kept = table["place"].to_numpy(), table["kept"].to_numpy(zero_copy_only=False)
        if not kept.any():
            return
        trie = Trie(words, code[kept], place[kept])
        for own, near in trie.search(code[~kept], place[~kept]):
            both = np.concatenate([own, near]), np.concatenate([near, own])
            columns = [names.take(pa.array(both[0])), pa.array(n[both[0]]), names.take(pa.array(both[1])), pa.array(n[both[1]])]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "near", "near_n"])

    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        last = batch.column(0)[-1].as_py()
        if rows >= TRIE_WORDS and held[0]["place"][0].as_py() != last:
            whole = pa.concat_tables(held)
            cut = int(np.searchsorted(whole["place"].to_numpy(), last, side="left"))
            yield from pairs(whole.slice(0, cut))
            held, rows = [whole.slice(cut)], whole.num_rows - cut
    if held:
        yield from pairs(pa.concat_tables(held))


def near_words(words: DataFrame, levels: int = DEALT_LEVELS) -> DataFrame:
    """(word, n, near, near_n) of all pairs of the words (word, n) that are one edit apart, in both directions."""
    dealt = words.select("word", "n").mapInArrow(lambda batches: _dealt(batches, levels), "place bigint, word string, n bigint, kept boolean")
    return dealt.repartition("place").sortWithinPartitions("place").mapInArrow(_found, "word string, n bigint, near string, near_n bigint")


def group_spellings(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words (word, n): `form` is the most frequent near word if it occurs at
    least `dominance` times as often, `root` the end of the chain of forms."""
    words = stage(words.select("word", "n"), "words")
    levels = WIDE_LEVELS if words.count() > WIDE else DEALT_LEVELS
    first = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    best = near_words(words, levels).groupBy("word").agg(F.count("*").alias("n_near"), first.alias("best"))
    joined = words.join(best, "word", "left")
    dominant = -F.col("best.less") >= dominance * F.col("n")
    found = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(dominant, F.col("best.near")).alias("form"),
        F.when(dominant, -F.col("best.less")).alias("form_n"),
    )
    found = stage(found, "word-forms")
    # forms grow by a factor, so chains are short; each round doubles how far every word has followed its chain
    chain = found.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        chain = stage(chain, "word-roots")
        step = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = chain.join(step, "root", "left")
        if moved.filter("further IS NOT NULL").isEmpty():
            break
        chain = moved.select("word", F.coalesce("further", "root").alias("root"))
    return found.join(chain, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of the words of all documents."""
    return group_spellings(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet")))


QUERIES = {"op12_spelling_variants": op12_spelling_variants}
SQL = {
    "op12_spelling_variants": r"""
WITH RECURSIVE crc_step AS (
  SELECT i AS entry, i AS value, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT entry, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, k + 1 FROM crc_step WHERE k < 8
), crc_table AS MATERIALIZED (SELECT list(value ORDER BY entry) AS t FROM crc_step WHERE k = 8
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL
), coded AS (SELECT doc_id, run, n, hex(encode(doc_id || ':' || run)) AS bytes FROM counted
), hashed AS (
  SELECT doc_id, run, n, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(len(bytes) // 2),
      lambda i: (strpos('0123456789ABCDEF', bytes[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', bytes[2 * i + 2]) - 1)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM coded, crc_table
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, w.word FROM cuts a JOIN words w ON a.rest = w.word
  UNION SELECT w.word, a.word FROM cuts a JOIN words w ON a.rest = w.word
), best AS (
  SELECT p.word, count(*) AS n_near, max(w.n) AS most, arg_min(p.near, (-w.n, p.near)) AS near FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word
), forms AS MATERIALIZED (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN near END AS form, CASE WHEN most >= 5 * n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, 0 AS k FROM forms
  UNION ALL
  SELECT c.word, f.form, k + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word) USING (word)
"""
}
