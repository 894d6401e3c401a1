"""Deletion vectors for tests, laid out by the published format."""

import base64
import json
import struct
import uuid
import zlib

import numpy as np

from lakeship.sources import table

MAGIC, NO_RUNS, MOST_IN_ARRAY = 1681511377, 12346, 4096


def bitmap(positions):
    """A 64-bit Roaring bitmap: 32-bit ones by their upper half, each of array and bitset containers."""
    positions = np.unique(np.array(positions, dtype="int64"))
    out = b""
    highs = np.unique(positions >> 32)
    for high in highs:
        low = positions[positions >> 32 == high] & 0xFFFFFFFF
        keys = np.unique(low >> 16)
        header, offsets, bodies = b"", b"", b""
        for key in keys:
            values = low[low >> 16 == key] & 0xFFFF
            header += struct.pack("<HH", key, len(values) - 1)
            offsets += struct.pack("<I", 8 + 8 * len(keys) + len(bodies))
            bits = np.zeros(1 << 16, dtype="u1")
            bits[values] = 1
            dense = len(values) > MOST_IN_ARRAY
            bodies += np.packbits(bits, bitorder="little").tobytes() if dense else values.astype("<u2").tobytes()
        out += struct.pack("<III", high, NO_RUNS, len(keys)) + header + offsets + bodies
    return struct.pack("<iq", MAGIC, len(highs)) + out


def z85(data):
    return base64.z85encode(data + b"\0" * (-len(data) % 4)).decode()


def mark(spark, root, marks, inline=False):
    """Commit vectors for live files; `marks` gives the deleted positions by logged path."""
    snap = table.snapshot(spark, root)
    old = {row.raw_path: row for row in snap.files.collect()}
    name, stored = uuid.uuid4(), b"\1"
    features = ["deletionVectors"]
    lines = [{"protocol": {"minReaderVersion": 3, "minWriterVersion": 7, "readerFeatures": features, "writerFeatures": features}}]
    for path, positions in marks.items():
        blob, file = bitmap(positions), old[path]
        vector = {"sizeInBytes": len(blob), "cardinality": len(positions)}
        if inline:
            vector |= {"storageType": "i", "pathOrInlineDv": z85(blob)}
        else:
            vector |= {"storageType": "u", "pathOrInlineDv": z85(name.bytes), "offset": len(stored)}
            stored += struct.pack(">i", len(blob)) + blob + struct.pack(">I", zlib.crc32(blob))
        remove = {"path": path, "partitionValues": file.partition_values, "size": file.size, "dataChange": True}
        if file.vector is not None:
            remove["deletionVector"] = {k: v for k, v in file.vector.asDict().items() if v is not None}
        add = {k: v for k, v in remove.items() if k != "deletionVector"}
        lines += [{"remove": remove}, {"add": add | {"modificationTime": file.modified, "deletionVector": vector}}]
    if not inline:
        with open(f"{root}/deletion_vector_{name}.bin", "wb") as out:
            out.write(stored)
    with open(f"{root}/_delta_log/{snap.version + 1:020d}.json", "w") as out:
        out.write("".join(json.dumps(line) + "\n" for line in lines))
