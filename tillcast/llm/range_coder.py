"""Context-mixing range coder for token ids.

Ids are cut into blocks that reset all state, so any block can be decoded alone.  A block begins with its distinct
ids in ascending order and the count of each (Exp-Golomb codes of the gaps and of the counts).  They number the
ids, and each next number is predicted by three orders:

* order 2: the number that last followed the two before,
* order 1: the number that last followed the one before,
* order 0: how often each number is left in the block, brought up to date wherever a third of the rest is coded.

The prediction is their mixture: a number's probability is the sum of the shares that the orders give it, so
the guesses of orders 2 and 1 also get what order 0 holds for them, and both their shares where they agree.  The
orders' weights are adaptive, one set for each pair of confidences in the two guesses and for whether these agree,
learned inside the block.  A guess of which nothing is left gets nothing.  A range coder (64-bit state, 32-bit
output) codes a number as one interval of the mixture: the guesses' parts come first, then all others in their order.

Blocks are coded side by side, one NumPy lane each, so the cost per id is that of a few array
operations; ``LANES`` of them at a time bound the memory.  Every block carries a CRC of its ids.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 4096  # 2^12 ids at most: an entry of a number and its confidence fits 16 bits
LANES = 2048
ID_BITS = 20  # ids below 2^20; fewer bits where the caller knows fewer
_PLACES, _ORDER2 = 12, 12  # log2 of a block's places, and of the entries of a lane's order-2 table
_REST = 32  # order 0 stays as it is over so many last ids
_GAP_BITS = np.array([8, 4, 2, 1])  # the lowest bits of a gap, written as they are
_MIX1, _MIX2 = 2741, 1597
# Shares of orders 2 and 1 are in units of 2^-12; order 0 has the rest, which is never less than one unit.
_SHARE, _DECAY, _CREDIT = 12, 5, 127
# A guess's confidence (0 to 7) moves by so much after a miss (first eight) or a hit; the lowest ones are replaced at a miss.
_MOVES = np.array([0, 0, -1, -2, -2, -3, -3, -4, 1, 1, 1, 1, 1, 1, 1, 0]).astype(np.uint16)
# The range coder's state has 63 bits, so that a carry shows above them; spans below 2^31 are widened by a word.
_BOTTOM, _TOP, _WORD, _KEPT = np.uint64(1 << 31), np.uint64(31), np.uint64(32), np.uint64((1 << 31) - 1)
_LOW32 = np.uint64((1 << 32) - 1)


def _first() -> np.ndarray:
    """Shares of orders 2 and 1 at a block's start by (agreement, confidence of order 2, of order 1)."""
    sure2 = np.array([0, 0.04, 0.3, 0.55, 0.65, 0.7, 0.75, 0.8])[:, None]
    sure1 = np.array([0, 0.04, 0.2, 0.45, 0.6, 0.65, 0.7, 0.8])[None, :]
    apart = np.stack([sure2 + 0 * sure1, (1 - sure2) * sure1], axis=-1)
    agreed = np.stack([np.minimum(sure2 + sure1, 0.95), 0 * sure1 * sure2], axis=-1)
    # Equal guesses are one, that of order 2.
    shares = np.stack([apart, agreed])
    return (shares * ((1 << _SHARE) - 1)).astype(np.uint16).ravel()


_FIRST = _first()


class _Model:
    """Tables, counts and weights of all lanes; both directions read and update it alike.

    Arrays of two rows hold order 2 in the first and order 1 in the second.  Numbers begin at one; zero is no guess.
    """

    def __init__(self, counts: np.ndarray, steps: int):
        lanes, self.width = counts.shape
        self.left, self.rest = counts, steps
        lane = np.arange(lanes)
        self.at = lane * self.width
        after = lanes * self.width
        self.at2 = after + (lane << _ORDER2)
        self.at_row = np.stack([lane * len(_FIRST), lane * len(_FIRST) + 1])
        # An entry is number * 8 + confidence.
        self.table = np.zeros(after + (lanes << _ORDER2), np.uint16)
        self.weights = np.tile(_FIRST, lanes)
        self.slot = np.stack([self.at2, self.at])
        self.before = np.zeros(lanes, np.int64)
        self.parts = np.empty((2, lanes), np.uint32)
        # Arrays are cheaper operands than single numbers.
        self.three, self.seven, self.two, self.credit, self.decay = (
            np.full((2, lanes), n, np.uint16) for n in (3, 7, 2, _CREDIT, _DECAY)
        )
        self.one = np.ones(lanes, np.uint16)
        self.low, self.high = (np.full((2, lanes), n, np.uint32) for n in (0xFFFF, 16))
        # Where the weights lie by agreement and confidences, two in each place.
        self.strides, self.agreed = np.repeat([[16], [2]], lanes, axis=1).astype(np.uint16), np.full(lanes, 128, np.uint16)
        self.whole = np.full(lanes, 1 << _SHARE, np.uint32)
        self.mix1, self.mix2, self.mask2 = (np.full(lanes, n) for n in (_MIX1, _MIX2, (1 << _ORDER2) - 1))
        self._lay()

    def _lay(self) -> None:
        """The line of order 0: where each number begins (upper 16 bits) and how often it is left."""
        ends = np.cumsum(self.left, axis=1, dtype=np.uint32)
        self.line = ((ends - self.left) << 16 | self.left).ravel()
        self.rests = np.full((2, len(self.left)), self.rest, np.uint32)
        self.total = np.uint64(self.rest << _SHARE)

    def take_out(self, numbers: np.ndarray) -> None:
        """Order 0 without the numbers (step, lane) coded since the last time."""
        used = np.bincount((numbers + self.at).ravel(), minlength=self.left.size)
        self.left = self.left - used.reshape(self.left.shape).astype(np.uint32)
        self.rest -= len(numbers)
        self._lay()

    def places(self) -> np.ndarray:
        """The number at each place of the lines of all lanes."""
        names = np.broadcast_to(np.arange(self.width, dtype=np.uint16), self.left.shape).ravel()
        return np.repeat(names, self.left.ravel())

    def predict(self) -> None:
        """Both guesses and the sizes of their parts; all sizes are in units of a share times an order-0 count."""
        self.entry = self.table.take(self.slot, mode="clip")
        self.guess, self.sure = self.entry >> self.three, self.entry & self.seven
        same = self.guess[0] == self.guess[1]
        context = self.sure * self.strides
        self.row = self.at_row + (context[0] + context[1] + self.agreed * same)
        self.weight = self.weights.take(self.row, mode="clip")
        part = self.line.take(self.at + self.guess, mode="clip")
        np.copyto(part[1], 0, where=same)
        left = part & self.low
        # Nothing where none is left.
        share = np.minimum(self.weight, left * self.whole)
        # What each order-0 count is worth.
        self.unit = self.whole - share[0] - share[1]
        self.size = share * self.rests + self.unit * left
        self.guessed = self.size[0] + self.size[1]
        np.minimum(part[0], part[1], out=self.parts[0])
        np.maximum(part[0], part[1], out=self.parts[1])

    def learn(self, number: np.ndarray, index: np.ndarray, credit: np.ndarray) -> None:
        """Take in the number (as uint16 and int64); ``credit`` says whose part it was."""
        self.weights[self.row] = self.weight - (self.weight >> self.decay) + self.credit * credit
        hit = self.guess == number
        entry = self.entry + _MOVES.take((hit.view(np.uint8) << self.three) + self.sure, mode="clip")
        np.copyto(entry, number << self.three[0] | self.one, where=(self.sure < self.two) > hit)
        self.table[self.slot] = entry
        np.add(self.at2, index * self.mix1 + self.before & self.mask2, out=self.slot[0])
        np.add(self.at, index, out=self.slot[1])
        self.before = index * self.mix2


def _windows(steps: int) -> list[tuple[int, int]]:
    """Steps between which order 0 stays as it is: a third of the rest each time."""
    edges = [0]
    while steps - edges[-1] > _REST:
        edges.append(edges[-1] + (steps - edges[-1] + 2) // 3)
    return list(zip(edges, edges[1:] + [steps]))


def _blocks(ids: np.ndarray) -> np.ndarray:
    """Ids as (block, step); the last block is filled up with its last id."""
    blocks = -(-len(ids) // BLOCK)
    steps = BLOCK if blocks > 1 else len(ids)
    padded = np.full(steps * blocks, ids[-1], np.uint32)
    padded[: len(ids)] = ids
    return padded.reshape(blocks, steps)


def _numbered(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, their counts, and each id's number, from 1."""
    order = np.sort(block << np.uint32(_PLACES) | np.arange(len(block), dtype=np.uint32))
    ids = order >> np.uint32(_PLACES)
    begins = np.concatenate([[True], ids[1:] != ids[:-1]])
    number = np.empty(len(block), np.uint16)
    number[order & np.uint32((1 << _PLACES) - 1)] = np.cumsum(begins, dtype=np.uint16)
    return ids[begins].astype(np.int64), np.diff(np.flatnonzero(begins), append=len(block)), number


def _check(ids: np.ndarray) -> list[int]:
    """CRC-32 of each block's ids."""
    return [zlib.crc32(ids[i : i + BLOCK].astype("<u4").tobytes()) for i in range(0, len(ids), BLOCK)]


def _head(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """A block's distinct ids and their counts: how many, 32-bit words, lengths and bits of all codes, low bits of gaps."""
    n, low = len(ids), len(_GAP_BITS)
    gaps = np.diff(ids, prepend=-1) - 1
    codes = np.concatenate([(gaps >> low) + 1, counts])
    width = np.frexp(codes.astype(np.float64))[1] - 1
    ones, ends = np.cumsum(width + 1) - 1, np.cumsum(width)
    begin = ones[-1] + 1
    end = begin + ends[-1]
    bits = np.zeros(-(-(end + low * n) // 32) * 32, np.uint8)
    bits[ones] = 1
    bits[begin:end] = np.repeat(codes, width) >> np.repeat(ends, width) - 1 - np.arange(ends[-1]) & 1
    bits[end : end + low * n].reshape(n, low)[:] = gaps[:, None] & _GAP_BITS > 0
    return np.array([n, bits.size // 32], "<u2").tobytes() + np.packbits(bits).tobytes()


def _read_head(words: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Distinct ids, counts, and the words that they take; None if these can't be a block's."""
    n, size = words[:1].view("<u2").tolist()
    bits, low = np.unpackbits(words[1 : 1 + size].view(np.uint8)), len(_GAP_BITS)
    ones = np.flatnonzero(bits)[: 2 * n]
    if not 0 < n <= steps or len(ones) < 2 * n:
        return None
    width = np.diff(ones, prepend=-1) - 1
    ends = np.cumsum(width)
    begin = ones[-1] + 1
    end = begin + ends[-1]
    if width.max() > ID_BITS or end + low * n > bits.size:
        return None
    sums = np.zeros(ends[-1] + 1, np.int64)
    np.cumsum(bits[begin:end].astype(np.int64) << np.repeat(ends, width) - 1 - np.arange(ends[-1]), out=sums[1:])
    codes = sums[ends] - sums[ends - width] + (1 << width)
    if codes[n:].sum() != steps:
        return None
    gaps = (codes[:n] - 1 << low) + bits[end : end + low * n].reshape(n, low) @ _GAP_BITS
    return (np.cumsum(gaps + 1) - 1).astype("<u4"), codes[n:], 1 + size


def _by_number(counts: list[np.ndarray]) -> np.ndarray:
    """Counts as (block, number)."""
    out = np.zeros((len(counts), max(map(len, counts)) + 1), np.uint32)
    for row, count in zip(out, counts):
        row[1 : len(count) + 1] = count
    return out


class _Encoder:
    def __init__(self, lanes: int, room: int):
        self.low, self.span = np.zeros(lanes, np.uint64), np.full(lanes, 2**63 - 1, np.uint64)
        # Words with the carry to the one before.
        self.out, self.room = np.zeros(lanes * room, np.uint64), room
        self.place = np.arange(lanes) * room

    def narrow(self, start: np.ndarray, size: np.ndarray, total: np.uint64) -> None:
        """Code an interval of the total."""
        self.span //= total
        self.low += self.span * start
        self.span *= size
        due = (self.span < _BOTTOM).nonzero()[0]
        if due.size:
            low, spot = self.low.take(due), self.place.take(due)
            self.out[spot] = low >> _TOP
            self.place[due] = spot + 1
            self.low[due] = (low & _KEPT) << _WORD
            self.span[due] = self.span.take(due) << _WORD

    def finish(self) -> list[bytes]:
        """The words of each lane; the last one is left out where the span covers whatever may follow."""
        wide = self.span >> _WORD > 0
        self.low += wide * _KEPT
        self.out[self.place] = self.low >> _TOP
        self.out[self.place + 1] = np.where(wide, 0, (self.low & _KEPT) << np.uint64(1))
        filled = self.place - np.arange(len(self.low)) * self.room + np.where(wide, 1, 2)
        coded = []
        for row, n in zip(self.out.reshape(-1, self.room), filled.tolist()):
            words = row[:n]
            carry = words >> _WORD
            while carry.any():
                words = words & _LOW32
                words[:-1] += carry[1:]
                carry = words >> _WORD
            coded.append(words.astype("<u4").tobytes())
        return coded


def _encode_lanes(blocks: np.ndarray) -> list[bytes]:
    lanes, steps = blocks.shape
    ids, counts, numbers = zip(*map(_numbered, blocks))
    heads, numbers = list(map(_head, ids, counts)), np.stack(numbers, axis=1)
    # A step narrows the span to 2^-24 of it at least, so it puts out one word at most.
    model, coder = _Model(_by_number(counts), steps), _Encoder(lanes, steps + 4)
    credit = np.empty((2, lanes), bool)
    for begin, end in _windows(steps):
        if begin:
            model.take_out(numbers[steps - model.rest : begin])
        for number in numbers[begin:end]:
            model.predict()
            index = number.astype(np.int64)
            part = model.line.take(model.at + index, mode="clip")
            first = part > model.parts
            first = (model.parts & model.low) * first
            start = model.guessed + model.unit * ((part >> model.high[0]) - first[0] - first[1])
            size = model.unit * (part & model.low[0])
            np.equal(model.guess[0], number, out=credit[0])
            np.greater(model.guess[1] == number, credit[0], out=credit[1])
            np.copyto(start, model.size[0], where=credit[1])
            np.copyto(size, model.size[1], where=credit[1])
            np.copyto(start, 0, where=credit[0])
            np.copyto(size, model.size[0], where=credit[0])
            coder.narrow(start.astype(np.uint64), size.astype(np.uint64), model.total)
            model.learn(number, index, credit)
    return [head + coded for head, coded in zip(heads, coder.finish())]


def _batches(blocks: np.ndarray) -> list[np.ndarray]:
    """Blocks in batches of ``LANES`` at most, of almost equal size."""
    return np.array_split(blocks, -(-len(blocks) // LANES))


def encode(ids: np.ndarray, id_bits: int = ID_BITS) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Payload, bytes of each block in it, and CRC-32 of each block's ids as uint32."""
    if not len(ids):
        return b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
    if id_bits > ID_BITS or int(ids.max()) >> id_bits:
        raise ValueError(f"ids must lie below 2^{min(id_bits, ID_BITS)}")
    coded = [c for blocks in _batches(_blocks(ids)) for c in _encode_lanes(blocks)]
    return b"".join(coded), np.array(list(map(len, coded)), np.int64), np.array(_check(ids), np.int64)


class _Decoder:
    def __init__(self, words: np.ndarray, place: np.ndarray):
        # The state begins with 63 bits, so each further word lies one bit beside a stored one.
        self.words = words << np.uint32(31)
        self.words[:-1] |= words[1:] >> np.uint32(1)
        self.span = np.full(len(place), 2**63 - 1, np.uint64)
        # The code less the low end of the span.
        self.code = words.take(place, mode="clip").astype(np.uint64) << _TOP | self.words.take(place, mode="clip") & _KEPT
        self.place = place + 1

    def target(self, total: np.uint64) -> np.ndarray:
        """The place of the total that the code points to; divides the span by it."""
        self.span //= total
        return np.minimum(self.code // self.span, total - np.uint64(1)).astype(np.uint32)

    def narrow(self, start: np.ndarray, size: np.ndarray) -> None:
        """Take the interval found."""
        self.code -= self.span * start
        self.span *= size
        due = (self.span < _BOTTOM).nonzero()[0]
        if due.size:
            spot = self.place.take(due)
            self.code[due] = self.code.take(due) << _WORD | self.words.take(spot, mode="clip")
            self.span[due] = self.span.take(due) << _WORD
            self.place[due] = spot + 1


def _decode_lanes(words: np.ndarray, place: np.ndarray, steps: int, first: int) -> np.ndarray:
    """Ids as (lane, step); ``first`` is the number of the first block."""
    lanes = len(place)
    heads = [_read_head(words[p:], steps) for p in place.tolist()]
    for block, head in enumerate(heads, first):
        if head is None:
            raise ValueError(f"block {block}: its counts are damaged")
    ids, counts, taken = zip(*heads)
    model, coder = _Model(_by_number(counts), steps), _Decoder(words, place + np.array(taken))
    numbers = np.empty((steps, lanes), np.uint16)
    credit = np.empty((2, lanes), bool)
    for begin, end in _windows(steps):
        if begin:
            model.take_out(numbers[steps - model.rest : begin])
        places, at_place = model.places(), np.arange(lanes) * (steps - begin)
        for step in range(begin, end):
            model.predict()
            target = coder.target(model.total)
            np.less(target, model.size[0], out=credit[0])
            np.greater(target < model.guessed, credit[0], out=credit[1])
            # The place on the line without both guesses, then on the whole line; of no use inside their parts.
            rank = (target - model.guessed) // model.unit
            left, edge = model.parts & model.low, model.parts >> model.high
            edge[1] -= left[0]
            left *= rank >= edge
            spot = rank + left[0]
            spot += left[1]
            number = places.take(at_place + spot, mode="clip")
            part = model.line.take(model.at + number, mode="clip")
            start = model.guessed + model.unit * (rank + (part >> model.high[0]) - spot)
            size = model.unit * (part & model.low[0])
            for order, before in ((1, model.size[0]), (0, 0)):
                np.copyto(start, before, where=credit[order])
                np.copyto(size, model.size[order], where=credit[order])
                np.copyto(number, model.guess[order], where=credit[order])
            numbers[step] = number
            coder.narrow(start.astype(np.uint64), size.astype(np.uint64))
            model.learn(number, number.astype(np.int64), credit)
    return np.stack([known.take(number) for known, number in zip(ids, np.ascontiguousarray(numbers.T) - np.uint16(1))])


def decode(payload: bytes, sizes: np.ndarray, checks: np.ndarray, count: int) -> np.ndarray:
    """The ids (uint32); a block whose CRC differs is an error."""
    if not count:
        return np.zeros(0, "<u4")
    steps = BLOCK if len(sizes) > 1 else count
    words = np.frombuffer(payload, "<u4")
    place = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64) // 4)[:-1]])
    parts, first = [], 0
    for batch in _batches(place):
        parts.append(_decode_lanes(words, batch, steps, first).reshape(-1))
        first += len(batch)
    ids = np.concatenate(parts)[:count]
    for block, (found, check) in enumerate(zip(_check(ids), np.asarray(checks).tolist())):
        if found != check:
            raise ValueError(f"block {block}: the checksum of its ids differs")
    return ids
