"""SentencePiece encoding and decoding with a vocabulary that is given, never trained."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from llm.text import give_back

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# A worker remembers a third as many segments, and pairs of pieces (of short words, and of
# long ones), for as long as it lives, also while other stages run. Segments are in
# two generations: when the younger is full the older goes, but for what was used since.
CACHED = 900_000
_NEVER = float("-inf")
LONGEST = 64  # characters of a segment worth remembering


@dataclass
class Vocabulary:
    """Pieces with their ids and scores; bytes for characters that are no piece."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_from: int
    texts: list[bytes]
    name: str
    longest: int = field(init=False)
    spaces: int = field(init=False)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.ids))
        self.spaces = max(n for n in range(1, self.longest + 1) if SPACE * n in self.ids)


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Reads a model file. Kept to models whose pieces hold a space only in front."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, texts = {}, {}, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i):
            texts.append(b"")
        elif model.is_byte(i):
            texts.append(bytes([int(piece[1:-1], 16)]))
        else:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"a space inside piece {i}")
            ids[piece], scores[piece] = i, model.get_score(i)
            texts.append(piece.replace(SPACE, " ").encode())
    name = hashlib.sha256(repr(scores).encode()).hexdigest()
    return Vocabulary(ids, scores, model.piece_to_id("<0x00>"), texts, name)


def segments_of(pieces: Iterable[str]) -> re.Pattern[str]:
    """Finds runs of characters that pieces join, with the spaces before them.

    Characters are of one kind if neighbours inside pieces lead from one to the other.
    No merge goes over the border of a kind, nor on to a space, so each run has the ids
    that it has in the text. The largest kind (of letters, as a rule) makes runs of its
    own, all others make runs together.
    """
    kinds: dict[str, set[str]] = {}
    for piece in pieces:
        word = piece.lstrip(SPACE)
        for a, b in zip(word, word[1:]):
            less, more = sorted((kinds.setdefault(a, {a}), kinds.setdefault(b, {b})), key=len)
            if less is not more:
                more |= less
                kinds.update(dict.fromkeys(less, more))
    if not kinds:
        return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
    largest = "".join(map(re.escape, sorted(max(kinds.values(), key=len))))
    return re.compile(f"{SPACE}*(?:[{largest}]+|[^{largest}{SPACE}]+)|{SPACE}+")


class State(dict):
    """The longest end of the text so far that a piece may start with; the next by character.

    ``ends`` are the pieces of two or more characters that end here, the longest first, each
    with its length below zero and what is known of the pieces before it.
    """

    __slots__ = ("text", "ends", "encoder")

    def __init__(self, text: str, ends: list[tuple[int, str, dict]], encoder: Encoder) -> None:
        super().__init__()
        self.text, self.ends, self.encoder = text, ends, encoder

    def __missing__(self, c: str) -> State:
        return self.encoder._next(self, c)


class Encoder(dict):
    """Segments of text to the bytes of their ids (int32), as a bounded memory."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.v = vocabulary
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.find = segments_of(vocabulary.ids).findall
        self.raw = {p: array("i", [i]).tobytes() for p, i in vocabulary.ids.items()}
        self.starts = {p[:n] for p in vocabulary.ids for n in range(len(p) + 1)}
        self._forget()
        self.stories: dict[str, list[tuple[float, str, str]] | None] = {}

    def __missing__(self, segment: str) -> bytes:
        value = self.older.get(segment)
        if value is None:
            if len(segment) > LONGEST:
                return array("i", self._segment(segment)).tobytes()
            # One space in front at most, and a word behind it: the pieces are all there is.
            plain = segment != SPACE and not segment.startswith(SPACE * 2)
            value = self._word(segment) if plain else array("i", self._segment(segment)).tobytes()
        if len(self) >= CACHED // 6:
            self.older = dict(self)
            self.clear()
        self[segment] = value
        return value

    def encode(self, text: str) -> bytes:
        """The ids of a text as int32 bytes; a space is put before the text."""
        if not text:
            return b""
        text = SPACE + text.replace(" ", SPACE)
        return b"".join(map(self.__getitem__, self.find(text)))

    def _segment(self, segment: str) -> Iterator[int]:
        word = segment.lstrip(SPACE)
        spaces = len(segment) - len(word)
        if not word:
            yield from self._spaces(spaces)
            return
        first = True
        word = SPACE * (spaces > 0) + word
        for piece in self._short(word) if len(word) <= LONGEST else self.stream(word):
            if first:
                # Pieces of spaces alone merge after all others, from the left.
                rest = spaces if piece == SPACE else spaces - 1
                yield from self._spaces(rest)
                first = False
                if piece == SPACE:
                    continue
            yield from self._ids(piece)

    def _word(self, word: str) -> bytes:
        raw, found = self.raw, self._short(word)
        try:
            return b"".join([raw[piece] for piece in found])
        except KeyError:
            return array("i", [i for piece in found for i in self._ids(piece)]).tobytes()

    def _spaces(self, n: int) -> Iterator[int]:
        while n > 0:
            yield self.v.ids[SPACE * min(n, self.v.spaces)]
            n -= self.v.spaces

    def _ids(self, piece: str) -> Iterable[int]:
        known = self.v.ids.get(piece)
        if known is not None:
            return (known,)
        return [self.v.bytes_from + b for b in piece.encode("utf-8", "surrogatepass")]

    def stream(self, chars: Iterable[str]) -> Iterator[str]:
        """Pieces of a run of characters, each as soon as it is certain.

        One backpointer a position: the piece that ends there and may follow the one
        that ends at its start. In a vocabulary of merges there is one such piece, the
        last of the encoding up to there. Any later piece starts among the last
        ``longest`` positions; when the paths back from all of these meet in one
        boundary, what lies before it is committed and forgotten.
        """
        longest, ids = self.v.longest, self.v.ids
        window, back, due = "", [""], 2 * longest
        for c in chars:
            window += c
            i = len(window)
            for n in range(min(longest, i), 0, -1):
                piece = window[i - n :]
                if (n == 1 or piece in ids) and self._may_follow(back[i - n], piece):
                    break
            back.append(piece)
            if i >= due:
                cut = self._meeting(back, i)
                if cut:
                    yield from self._path(back, cut)
                    # The piece before the cut still decides what may follow it.
                    window, back = window[cut:], [back[cut], *back[cut + 1 :]]
                due = len(window) + longest
        yield from self._path(back, len(window))

    def _short(self, word: str) -> list[str]:
        """What stream() gives, for a word that its window holds whole."""
        if word in self.v.ids and self._story(word) is not None:
            return [word]
        back, state = [""], self.root
        for c in word:
            state = state[c]
            for n, piece, after in state.ends:
                left = back[n]
                fits = after.get(left)
                if fits is None:
                    fits = after[left] = self._stay_apart(left, piece)
                    self.learnt += 1
                if fits:
                    break
            else:
                piece = c
            back.append(piece)
        if self.learnt > CACHED // 3:
            self._forget()
        return self._path(back, len(word))

    def _forget(self) -> None:
        """States and pairs as if no word had been seen."""
        self.after: dict[str, dict[str, bool]] = {}
        self.root = State("", [], self)
        self.states = {"": self.root}
        self.learnt = 0  # states, ways between them, and pairs

    def _next(self, state: State, c: str) -> State:
        """The state behind a character, found once for each state and character."""
        text = state.text + c
        while text not in self.starts:
            text = text[1:]
        found = self.states.get(text)
        if found is None:
            ends = []
            # One character needs no look: it is what is left if nothing longer fits.
            for n in range(len(text), 1, -1):
                piece = text[-n:]
                # What its own characters do not merge to follows nothing.
                if piece in self.v.ids and self._story(piece) is not None:
                    ends.append((-n, piece, self.after.setdefault(piece, {})))
            found = self.states[text] = State(text, ends, self)
            self.learnt += 1
        state[c] = found
        self.learnt += 1
        return found

    def _meeting(self, back: list[str], end: int) -> int:
        """The last boundary on the paths of all positions a later piece can start at."""
        open_ = set(range(max(0, end - self.v.longest + 1), end + 1))
        while len(open_) > 1:
            last = max(open_)
            open_.remove(last)
            open_.add(last - len(back[last]) if last else 0)
        return max(0, open_.pop())

    @staticmethod
    def _path(back: list[str], end: int) -> list[str]:
        out = []
        while end > 0:
            out.append(back[end])
            end -= len(back[end])
        return out[::-1]

    def _may_follow(self, left: str, right: str) -> bool:
        """Whether merging both pieces' characters ends in just these two pieces."""
        held = self.pairs.get((left, right))
        if held is None:
            held = self._stay_apart(left, right)
            if len(self.pairs) >= CACHED // 3:
                self.pairs.clear()
            self.pairs[left, right] = held
        return held

    def _stay_apart(self, left: str, right: str) -> bool:
        """Follows the merges inside both; the two symbols at the border must never win."""
        a, b = self._story(left), self._story(right)
        if a is None or b is None:
            return False
        if not left:
            return True
        scores, i, j = self.v.scores, 0, 0
        while True:
            own, _, last = a[i]
            other, first, _ = b[j]
            border = scores.get(last + first)
            # Equal scores go from the left: inside left, the border, inside right.
            if border is not None and border > own and border >= other:
                return False
            if own == other == _NEVER:
                return True
            if own >= other:
                i += 1
            else:
                j += 1

    def _story(self, piece: str) -> list[tuple[float, str, str]] | None:
        """Score of the next merge, first and last symbol, before each merge of a piece.

        None if its characters do not end in the piece.
        """
        if piece in self.stories:
            return self.stories[piece]
        parts, scores, steps = list(piece), self.v.scores, []
        while len(parts) > 1:
            best, at = _NEVER, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1], _NEVER)
                if score > best:
                    best, at = score, k
            if at < 0:
                break
            steps.append((best, parts[0], parts[-1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        steps.append((_NEVER, parts[0] if parts else "", parts[-1] if parts else ""))
        story = steps if len(parts) <= 1 else None
        if len(piece) > 1 or len(self.stories) < CACHED:
            self.stories[piece] = story
        return story


def decode(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The text of ids: bytes joined, invalid UTF-8 replaced, the first space dropped."""
    table = vocabulary.texts
    text = b"".join([table[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text



_HELD: dict[str, Encoder] = {}


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    """The encoder of this process, so that tasks go on with what earlier ones learnt."""
    if vocabulary.name not in _HELD:
        _HELD.clear()
        _HELD[vocabulary.name] = Encoder(vocabulary)
    return _HELD[vocabulary.name]


def encode(
    docs: DataFrame, vocabulary: Vocabulary, column: str = "text", keep: bool = True
) -> DataFrame:
    """Each row with ids (int array), n_ids, ids_sha256 and round_trip.

    A null or empty text has no ids. round_trip says whether decoding gives the text
    again; it does unless the text holds the character U+2581, which is the mark of a
    space. Columns of the input with one of the new names are replaced, and the text
    itself goes unless ``keep``. Rows do not see each other. An empty table stays so.
    """
    new = [
        StructField("n_ids", LongType()), StructField("ids_sha256", StringType()),
        StructField("round_trip", BooleanType()),
        StructField("ids", ArrayType(IntegerType(), False)),
    ]
    names = {f.name for f in new}
    input_ = docs.select(*(f"`{f.name}`" for f in docs.schema.fields if f.name.lower() not in names))
    fields = [f for f in input_.schema.fields if keep or f.name != column]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for whole in batches:
            for batch in _pieces_of(whole, column):
                counts, digests, same, raw = [0], [], [], []
                for text in batch.column(column).to_pylist():
                    body = encoder.encode(text or "")
                    ids = memoryview(body).cast("i")
                    counts.append(counts[-1] + len(ids))
                    digests.append(hashlib.sha256(body).hexdigest())
                    same.append(decode(ids, vocabulary) == (text or ""))
                    raw.append(body)
                values = pa.Array.from_buffers(
                    pa.int32(), counts[-1], [None, pa.py_buffer(b"".join(raw))]
                )
                lists = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), values)
                sizes = [j - i for i, j in zip(counts, counts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(f.name) for f in fields),
                        pa.array(sizes, pa.int64()), pa.array(digests), pa.array(same), lists,
                    ],
                    names=[*(f.name for f in fields), *(f.name for f in new)],
                )
        give_back()

    return input_.mapInArrow(work, StructType([*fields, *new]))


def _pieces_of(batch: pa.RecordBatch, column: str, limit: int = 8 << 20):
    """Row ranges of about ``limit`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    at, held = 0, 0
    for i, n in enumerate(sizes.to_pylist()):
        if held and held + n > limit:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    if at < batch.num_rows:
        yield batch.slice(at)


def decode_column(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """Each row with ``text`` decoded from its ids; null ids give null."""
    fields = [f for f in rows.schema.fields if f.name != "text"]
    input_ = rows.select(*(f"`{f.name}`" for f in fields))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if x is None else decode(x, vocabulary)
                for x in batch.column(ids).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())],
                names=[*batch.schema.names, "text"],
            )

    return input_.mapInArrow(work, StructType([*fields, StructField("text", StringType())]))
