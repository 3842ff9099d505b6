"""Token ids as Arrow files: equal-length sequences and masks in fixed-size lists, read back by memory map.

Documents are range-partitioned by id, so each partition writes one pair of files of consecutive documents:
``ids-<p>.arrow`` holds record batches of fixed-size lists (``ids`` and a ``mask`` that is false on padding) and
``docs-<p>.arrow`` the id, start and length of each document within that file. Nothing is compressed, so a reader maps
sequence k of a batch without a copy. A table of (partition, ids, paths) is the dataset's manifest.

Defined cases: a null text is the empty text and gives the end id alone; rows that repeat an id are written one after
the other, by text; a null id sorts first; an empty table gives no files.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanforge.llm.shared import filesystem, publish, shared_folder, small_batches, written

END_ID = 1
#: Ids in a sequence; sequences in a record batch; bytes tokenised at once, those of a row beside its text; words in a worker's store.
LENGTH, BATCH, TEXT_BYTES, ROW_BYTES, STORE_WORDS = 1024, 512, 8 << 20, 64, 400_000
#: Marks that may follow a word's letters, the most of them coded apart; words in a text that the tokenizer is given.
MARKS, MOST_MARKS, TOGETHER = b".,;:!?#$%&*", 8, 256


def _binary(ids: list[np.ndarray], sizes: list[np.ndarray], kind: np.dtype) -> pa.Array:
    """Ids that lie one after the other, by word."""
    values = np.concatenate([np.zeros(0, kind), *ids])
    places = np.cumsum(np.concatenate([[0], *sizes]), dtype=np.int64) * kind.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(values)])


class WordCoder:
    """Ids of texts, word by word. In a vocabulary that drops white space and never joins over it, a text's ids are its
    words' ids in order, so a worker codes a word once while it meets it. The store holds words and ids in Arrow arrays;
    when it is full, the half that the fewest chunks had is let go.

    Arrow tells a chunk's words apart and finds them in the store, so that only new words come to Python. Where the
    vocabulary marks the ends of words, marks after letters are coded apart, and words of letters alone are coded many to
    a text: if its ids have as many ends as words, each has its own."""

    def __init__(self, vocabulary: str, kind: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.kind, self.tails = np.dtype(kind), {b"": b""}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        known = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(known.values(), default=0) + 1, bool)
        self.ends[[n for word, n in known.items() if suffix and word.endswith(suffix)]] = True
        self.marked = bool(self.ends.any())
        #: By word: its ids, whether these are one piece's, and how many chunks had it.
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.single, self.uses = np.zeros(0, bool), np.zeros(0, np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.kind) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _tail(self, tail: bytes) -> bytes | None:
        """The ids of marks after a word, None where they are not the word's ids and then theirs."""
        if tail not in self.tails:
            text = tail.decode()
            head, alone, joined = self._ids(["a", text, "a" + text])
            self.tails[tail] = alone.tobytes() if np.array_equal(np.concatenate([head, alone]), joined) else None
        return self.tails[tail]

    def _letters(self, words: list[str], ids: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        """Codes words of letters alone, many to a text."""
        for k in range(0, len(words), TOGETHER):
            part = words[k : k + TOGETHER]
            (found,) = self._ids([" ".join(part)])
            stops = np.flatnonzero(self.ends[found]) + 1
            if len(stops) == len(part) and stops[-1] == len(found):
                ids.append(found)
                sizes.append(np.diff(stops, prepend=0))
            elif len(part) == 1:
                self._plain(part, ids, sizes)
            else:  # a few words have more ends, as their letters are mapped to more than letters
                self._letters(part[: len(part) // 2], ids, sizes)
                self._letters(part[len(part) // 2 :], ids, sizes)

    def _plain(self, words: list[str], ids: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        for k in range(0, len(words), 2048):
            found = self._ids(words[k : k + 2048])
            ids += found
            sizes.append(np.array([len(x) for x in found], np.int64))

    def _learn(self, words: pa.Array) -> None:
        """Codes new words and puts them into the store."""
        letters = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False) & self.marked
        ids, sizes = [], []
        self._letters(words.filter(pa.array(letters)).to_pylist(), ids, sizes)
        self._plain(words.filter(pa.array(~letters)).to_pylist(), ids, sizes)
        order = np.argsort(np.argsort(~letters, kind="stable"), kind="stable")
        coded = _binary(ids, sizes, self.kind).take(pa.array(order))
        places = np.frombuffer(coded.buffers()[1], np.int64)[: len(coded) + 1] // self.kind.itemsize
        values = np.frombuffer(coded.buffers()[2] or b"", self.kind)
        ends = np.diff(np.concatenate([[0], np.cumsum(self.ends[values])])[places])
        self.ids = pa.concat_arrays([self.ids, coded])
        self.single = np.concatenate([self.single, (np.diff(places) == 1) | (ends == 1)])
        self.uses = np.concatenate([self.uses, np.zeros(len(coded), np.int64)])

    def _places(self, words: pa.Array) -> np.ndarray:
        """The words' places in the store, into which new ones come."""
        both = pa.chunked_array([self.words, words]).dictionary_encode()
        met = both.chunk(both.num_chunks - 1)
        if len(met.dictionary) > len(self.words):
            self._learn(met.dictionary.slice(len(self.words)))
            self.words = met.dictionary
        at = met.indices.to_numpy()
        self.uses[at] += 1
        return at

    def _forget(self) -> None:
        if len(self.words) > STORE_WORDS:
            keep = np.sort(np.argpartition(-self.uses, STORE_WORDS // 2)[: STORE_WORDS // 2])
            self.words, self.ids = self.words.take(pa.array(keep)), self.ids.take(pa.array(keep))
            self.single, self.uses = self.single[keep], self.uses[keep] // 2
        if len(self.tails) > STORE_WORDS:
            self.tails = {b"": b""}

    def _coded(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words. Letters that marks follow are kept without these."""
        if not self.marked:
            return self.ids.take(pa.array(self._places(words)))
        heads = pc.ascii_rtrim(words, characters=MARKS.decode())
        marks = pc.subtract(pc.binary_length(words), pc.binary_length(heads)).to_numpy()
        tailed = np.flatnonzero((marks > 0) & (marks <= MOST_MARKS) & pc.utf8_is_alpha(heads).to_numpy(zero_copy_only=False))
        # The marks as bytes of a number, so that the few that differ are found without a step a word.
        stops = np.frombuffer(words.buffers()[1], np.int64)[words.offset + 1 :][tailed]
        data, keys = np.frombuffer(words.buffers()[2] or b"", np.uint8), np.zeros(len(tailed), np.uint64)
        for k in range(MOST_MARKS):
            more = np.flatnonzero(marks[tailed] > k)
            keys[more] |= data[stops[more] - 1 - k].astype(np.uint64) << np.uint64(8 * k)
        keys, number = np.unique(keys, return_inverse=True)
        tails = [self._tail(int(x).to_bytes(MOST_MARKS, "big").lstrip(b"\0")) for x in keys]
        fits = np.array([x is not None for x in tails], bool)[number]
        tailed, number = tailed[fits], number[fits]
        apart = np.zeros(len(words), bool)
        apart[tailed] = True
        at = self._places(pc.if_else(pa.array(apart), heads, words)).astype(np.int64)
        # Some letters are mapped to more than letters, which marks may join.
        odd = ~self.single[at[tailed]]
        if odd.any():
            at[tailed[odd]] = self._places(words.take(pa.array(tailed[odd])))
        after = np.zeros(len(words), np.int64)
        after[tailed[~odd]] = number[~odd] + 1
        marked = pa.array([b"", *(x or b"" for x in tails)], pa.large_binary()).take(pa.array(after))
        return pc.binary_join_element_wise(self.ids.take(pa.array(at)), marked, pa.scalar(b"", pa.large_binary()))

    def code(self, texts: pa.Array) -> list[memoryview]:
        if not len(texts):
            return []
        self._forget()
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        met = split.flatten().dictionary_encode()
        coded = self._coded(met.dictionary.cast(pa.large_string())).take(met.indices)
        # The words' ids lie one after the other; a text's are those between its first word and the next text's.
        places = np.frombuffer(coded.buffers()[1], np.int64)[: len(coded) + 1]
        at = places[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        raw = memoryview(coded.buffers()[2] or b"")
        return [raw[x:y] for x, y in zip(at, at[1:], strict=False)]


@lru_cache(1)
def _coder(vocabulary: str, kind: str) -> WordCoder:
    """One for a worker's life."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordCoder(vocabulary, kind)


def _by_bytes(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, pa.Array]]:
    """Keys and texts, in parts of about ``limit`` bytes, over batches; a longer text is a part of its own."""
    keys, texts, total, long, last = [], [], 0, 0, 0
    for batch in batches:
        key, text, at = batch.column("doc_id"), batch.column("text"), 0
        # A row counts for its key too, so that parts of empty texts end as well.
        sizes = pc.binary_length(text).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES
        ends, longs = total + np.cumsum(sizes), long + np.cumsum(sizes > limit)
        number = ends // limit + longs - (sizes > limit)
        for cut in [*np.flatnonzero(np.diff(number, prepend=last)).tolist(), None]:
            stop = len(text) if cut is None else cut
            if stop > at:
                keys += key.slice(at, stop - at).to_pylist()
                texts.append(text.slice(at, stop - at))
                at = stop
            if cut is not None and keys:
                yield keys, pa.concat_arrays(texts)
                keys, texts = [], []
        if len(text):
            total, long, last = int(ends[-1]), int(longs[-1]), int(number[-1])
    if keys:
        yield keys, pa.concat_arrays(texts)


def _sequences(ids: np.ndarray, mask: np.ndarray, length: int) -> pa.RecordBatch:
    kind = pa.from_numpy_dtype(ids.dtype)
    fixed = lambda values: pa.FixedSizeListArray.from_arrays(values, length)
    return pa.record_batch({"ids": fixed(pa.array(ids, kind)), "mask": fixed(pa.array(mask))})


def write_arrow(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, length: int = LENGTH, partitions: int | None = None) -> DataFrame:
    """Writes ``doc_id, text`` as token files into a shared folder; returns the manifest, itself written there."""
    spark = docs.sparkSession
    from tokenizers import Tokenizer

    kind = "uint16" if Tokenizer.from_file(vocabulary).get_vocab_size() <= 1 << 16 else "uint32"
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], kind).tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        coder, sink, held = _coder(vocabulary, kind), None, b""
        keys, starts, sizes, total = [], [], [], 0
        target = f"{folder}/ids-{part:06d}.arrow"
        width = np.dtype(kind).itemsize
        whole = length * BATCH * width
        for ids, texts in _by_bytes(batches, TEXT_BYTES):
            if sink is None:
                system, path = filesystem(target)
                system.create_dir(path.rpartition("/")[0], recursive=True)
                own = f"{path}.{TaskContext.get().taskAttemptId()}.tmp"
                stream = system.open_output_stream(own)
                sink = pa.ipc.new_file(stream, _sequences(np.zeros(0, kind), np.zeros(0, bool), length).schema)
            parts = [held]
            for key, coded in zip(ids, coder.code(texts), strict=True):
                parts += [coded, end]
                keys.append(key)
                starts.append(total)
                sizes.append(len(coded) // width + 1)
                total += sizes[-1]
            held = b"".join(parts)
            while len(held) >= whole:
                sink.write_batch(_sequences(np.frombuffer(held[:whole], kind), np.ones(length * BATCH, bool), length))
                held = held[whole:]
        if sink is None:
            return
        values = np.frombuffer(held, kind)
        if len(values):
            pad = -len(values) % length
            sink.write_batch(_sequences(np.concatenate([values, np.zeros(pad, kind)]), np.arange(len(values) + pad) < len(values), length))
        sink.close()
        stream.close()
        system.move(own, path)
        index, buffer = pa.table({"doc_id": pa.array(keys, pa.int64()), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(sizes, pa.int64())}), pa.BufferOutputStream()
        with pa.ipc.new_file(buffer, index.schema) as out:
            out.write_table(index)
        publish(f"{folder}/docs-{part:06d}.arrow", buffer.getvalue().to_pybytes())
        yield pa.RecordBatch.from_pylist([{"part": part, "ids": total, "path": target, "index_path": f"{folder}/docs-{part:06d}.arrow"}])

    return written(ordered.mapInArrow(write, "part long, ids long, path string, index_path string"), "arrow-manifest")


def _mapped(path: str):
    system, local = filesystem(path)
    return pa.memory_map(local) if system.type_name == "local" else system.open_input_file(local)


def read_arrow(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start over all files in order, n_tokens, ids_crc32 (of little-endian 32-bit ids)."""
    # One row per file: the running sum sees as many rows as there are files, not documents.
    based = manifest.withColumn("base", F.sum("ids").over(Window.orderBy("part")) - F.col("ids"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _documents(row["path"], row["index_path"], row["base"])

    files = manifest.count()
    return based.repartition(max(1, min(files, 10_000)), "part").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(path: str, index_path: str, base: int) -> Iterator[pa.RecordBatch]:
    with _mapped(path) as source, _mapped(index_path) as second:
        file, index = pa.ipc.open_file(source), pa.ipc.open_file(second).read_all()
        starts, sizes = (index.column(k).to_numpy() for k in ("start", "n_tokens"))
        # Batches but the last hold BATCH sequences each, so the batch of any id follows from its place.
        length = file.schema.field("ids").type.list_size
        step, number, crc, crcs = length * BATCH, -1, 0, np.zeros(len(starts), np.int64)
        for k, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
            at, stop, crc = start, start + size, 0
            while at < stop:
                if at // step != number:
                    number = at // step
                    values = file.get_batch(number).column("ids").flatten().to_numpy(zero_copy_only=True)
                upto = min(stop, (number + 1) * step)
                crc = zlib.crc32(values[at - number * step : upto - number * step].astype("<u4").tobytes(), crc)
                at = upto
            crcs[k] = crc
        yield pa.record_batch({"doc_id": index.column("doc_id").combine_chunks(), "start": pa.array(starts + base), "n_tokens": pa.array(sizes), "ids_crc32": pa.array(crcs)})


def op3_arrow_tokens(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return read_arrow(write_arrow(docs, shared_folder(spark, "arrow-tokens"), vocabulary))
