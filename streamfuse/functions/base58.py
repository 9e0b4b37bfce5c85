"""Base58 text of binary columns, a whole Arrow batch at a time."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the base58 alphabet.
ALPHABET = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
# Five digits are taken per division, so that remainders and one 32-bit limb fit in 64 bits.
DIGITS = 5
STEP = 58**DIGITS


# Values up to this length are divided side by side; the work grows with the square of the length.
WIDEST = 256
# Bytes of one step of that, counting every value at the length of its class.
STEP_BYTES = 1 << 22


def encode(values: pa.Array) -> pa.Array:
    """Base58 text of each value; leading zero bytes become leading ones; null stays null.

    Values of like length are encoded together, so that a long one does not widen the others, a
    bounded number of bytes at a time. Long values are halved until they are short.
    """
    values = values.cast(pa.large_binary())
    lengths = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_numpy(zero_copy_only=False)
    classes = np.ceil(np.log2(np.maximum(lengths, 16))).astype(np.int64)
    texts, order = [], []
    for size in np.unique(classes):
        rows = np.flatnonzero(classes == size)
        if 1 << size > WIDEST:
            made = [long_text(values[int(i)].as_py()) for i in rows]
            texts.append(pa.array(made, pa.string()))
        else:
            step = max(1, STEP_BYTES >> size)
            for at in range(0, len(rows), step):
                texts.append(_encode_alike(values.take(pa.array(rows[at : at + step]))))
        order.append(rows)
    if len(texts) == 1:
        return texts[0]
    if not texts:
        return pa.array([], pa.string())
    back = np.argsort(np.concatenate(order), kind="stable")
    return pa.concat_arrays(texts).take(pa.array(back))


def long_text(value: bytes) -> str:
    """The same for one long value, by dividing the number in halves of its digits."""
    number = int.from_bytes(value, "big")
    powers = [58**64]
    while powers[-1] <= number:
        powers.append(powers[-1] ** 2)

    def digits(n: int, level: int) -> str:
        if level < 0:
            out = bytearray(64)
            for i in range(63, -1, -1):
                n, rest = divmod(n, 58)
                out[i] = ALPHABET[rest]
            return out.decode()
        high, low = divmod(n, powers[level])
        return digits(high, level - 1) + digits(low, level - 1)

    zeros = len(value) - len(value.lstrip(b"\0"))
    return "1" * zeros + digits(number, len(powers) - 1).lstrip("1")


def _encode_alike(values: pa.Array) -> pa.Array:
    """Values of like length, as one grid."""
    n = len(values)
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset :][: n + 1]
    lengths = np.diff(offsets) if n else np.zeros(0, dtype=np.int64)
    if n == 0 or lengths.max() == 0:
        empty = pa.array([""] * n, pa.string())
        return _with_nulls(empty, values)
    width = -(-int(lengths.max()) // 4) * 4

    # Right-aligned bytes, as big-endian 32-bit limbs.
    data = np.frombuffer(values.buffers()[2], dtype=np.uint8)
    column = np.arange(width)
    inside = column >= width - lengths[:, None]
    source = offsets[1:, None] - width + column
    grid = np.where(inside, data[np.where(inside, source, offsets[0])], 0).astype(np.uint8)
    zeros = np.where((grid != 0).any(axis=1), (grid != 0).argmax(axis=1), width)
    leading = zeros - (width - lengths)
    limbs = np.ascontiguousarray(grid).view(">u4").astype(np.uint64).T.copy()

    # Long division by 58**5, least significant digits last.
    groups = -(-(width * 138 // 100 + 1) // DIGITS)
    digits = np.zeros((n, groups * DIGITS), dtype=np.uint8)
    for step, g in enumerate(range(groups - 1, -1, -1)):
        rest = np.zeros(n, dtype=np.uint64)
        # Each division takes more than 29 bits, so limbs in front are already zero.
        for limb in limbs[step * 29 // 32 :]:
            value = (rest << np.uint64(32)) | limb
            limb[:] = value // np.uint64(STEP)
            rest = value - limb * np.uint64(STEP)
        low = rest.astype(np.uint32)
        for d in range(DIGITS - 1, -1, -1):
            high = low // np.uint32(58)
            digits[:, g * DIGITS + d] = low - high * np.uint32(58)
            low = high

    # Ones for the leading zero bytes sit right before the first digit that counts.
    total = digits.shape[1]
    used = np.where((digits != 0).any(axis=1), total - (digits != 0).argmax(axis=1), 0)
    pad = int(leading.max())
    framed = np.concatenate([np.zeros((n, pad), dtype=np.uint8), digits], axis=1)
    keep = np.arange(pad + total) >= (pad + total - used - leading)[:, None]
    text = np.frombuffer(ALPHABET, dtype=np.uint8)[framed][keep]
    ends = np.concatenate([[0], np.cumsum(used + leading)]).astype(np.int64)
    buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(text.tobytes())]
    encoded = pa.LargeStringArray.from_buffers(n, buffers[1], buffers[2]).cast(pa.string())
    return _with_nulls(encoded, values)


def _with_nulls(encoded: pa.Array, values: pa.Array) -> pa.Array:
    return pa.compute.if_else(values.is_valid(), encoded, pa.scalar(None, pa.string()))


def encode_nested(values: pa.Array) -> pa.Array:
    """The same for every binary leaf of nested lists, maps and structs."""
    kind = values.type
    if pa.types.is_binary(kind) or pa.types.is_large_binary(kind):
        return encode(values)
    if pa.types.is_list(kind):
        items = encode_nested(values.flatten())
        return pa.ListArray.from_arrays(_offsets(values), items, mask=values.is_null())
    if pa.types.is_map(kind):
        start, stop = values.offsets[0].as_py(), values.offsets[-1].as_py()
        keys = encode_nested(values.keys.slice(start, stop - start))
        items = encode_nested(values.items.slice(start, stop - start))
        shifted = pa.array(values.offsets.to_numpy() - start, pa.int32())
        shape = pa.map_(keys.type, items.type)
        return pa.MapArray.from_arrays(shifted, keys, items, shape, mask=values.is_null())
    if pa.types.is_struct(kind):
        parts = [encode_nested(p) for p in values.flatten()]
        names = [kind.field(i).name for i in range(kind.num_fields)]
        return pa.StructArray.from_arrays(parts, names=names, mask=values.is_null())
    return values


def _offsets(values: pa.Array) -> pa.Array:
    lengths = pa.compute.fill_null(pa.compute.list_value_length(values), 0).to_numpy()
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())


def text_type(kind: T.DataType) -> T.DataType:
    """The type a value has once its binary leaves are text."""
    if isinstance(kind, T.BinaryType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(text_type(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(text_type(kind.keyType), text_type(kind.valueType), kind.valueContainsNull)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, text_type(f.dataType), True) for f in kind])
    return kind


def encoder(kind: T.DataType):
    """An Arrow function that encodes the binary leaves of one column type.

    It takes an array and no iterator: Spark gives all such functions of a projection to one Python worker, but one over
    iterators a worker of its own.
    """

    def run(values: pa.Array) -> pa.Array:
        return encode_nested(values)

    return F.arrow_udf(run, text_type(kind))


def base58(column: Column | str) -> Column:
    """Base58 text of a binary column. Call it after rows were filtered and split, not before."""
    return encoder(T.BinaryType())(column)
