"""Many small files of a local or mounted folder, written and read inside Python workers.

The module travels with the job.
"""

from __future__ import annotations

import fnmatch
import os
import sys
import uuid

import pyarrow as pa
from pyspark import cloudpickle

# Files a row of ``chunks`` stands for, and rows of one folder at most.
CHUNK_FILES, FOLDER_CHUNKS = 1_000, 256
# Bytes sent at once; a larger file is a batch of its own.
BATCH_BYTES = 1 << 23


def written(batches, root: str):
    """``(folder, place, id)`` of every row of ``(id, folder, content)``, sorted by folder, once its file stands.

    A file gets its name when it is whole, so an attempt that is repeated leaves the same files.
    """
    folder, place, own = None, 0, f".{uuid.uuid4().hex}"
    for batch in batches:
        folders, places = batch.column(1).to_pylist(), []
        for here, content in zip(folders, batch.column(2)):
            if here != folder:
                folder, place, below = here, 0, f"{root}/folder={here}"
                os.makedirs(below, exist_ok=True)
            with open(f"{below}/{own}", "wb", buffering=0) as file:
                left = memoryview(content.as_buffer())
                while len(left):
                    left = left[file.write(left) :]
            os.replace(f"{below}/{own}", f"{below}/part-{here:05d}.c{place:06d}.txt")
            places.append(place)
            place += 1
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(places, pa.int32()), batch.column(0)], ["folder", "place", batch.schema.names[0]])


def _visible(name: str) -> bool:
    """What Spark's scans list."""
    return not (name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"))


def _names(folder: str, pattern: str):
    with os.scandir(folder) as entries:
        for entry in entries:
            if _visible(entry.name) and fnmatch.fnmatchcase(entry.name, pattern) and entry.is_file():
                yield entry.name


def chunks(root: str, pattern: str) -> list[tuple[str, int, int]]:
    """``(folder, part, parts)`` of the files below ``root``; no list of files is kept."""
    found, waiting = [], [root]
    while waiting:
        folder, count = waiting.pop(), 0
        with os.scandir(folder) as entries:
            for entry in entries:
                if not _visible(entry.name):
                    continue
                if entry.is_dir():
                    waiting.append(entry.path)
                elif fnmatch.fnmatchcase(entry.name, pattern):
                    count += 1
        parts = min(-(-count // CHUNK_FILES), FOLDER_CHUNKS)
        found += [(folder, part, parts) for part in range(parts)]
    return found


def contents(batches, pattern: str):
    """``(file_name, path, content)`` of the files of ``chunks``."""
    names, paths, files, size = [], [], [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(paths, pa.string()), pa.array(files, pa.binary())], ["file_name", "path", "content"])

    for rows in batches:
        for row in rows.to_pylist():
            listed = sorted(_names(row["folder"], pattern))
            for name in listed[row["part"] :: row["parts"]]:
                with open(f"{row['folder']}/{name}", "rb", buffering=0) as file:
                    content = file.readall()
                if not content:
                    continue  # as in Spark's scan
                if size and size + len(content) > BATCH_BYTES:
                    yield batch()
                    names, paths, files, size = [], [], [], 0
                names.append(name)
                paths.append(f"file:{row['folder']}/{name}")
                files.append(content)
                size += len(content)
    if names:
        yield batch()


cloudpickle.register_pickle_by_value(sys.modules[__name__])
