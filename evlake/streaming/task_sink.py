"""A sink whose tasks write to a target outside Spark, with commit and abort.

Every task stages its rows in a file of its own on the target and tells the driver its
name, nothing more. Commit moves the staged files of a batch into the batch's folder and
marks it as whole; abort deletes them. A task that fails, or one that runs twice, leaves
a file no commit names. A batch that is whole already is not written again, so a repeat
after a crash makes no copies; readers take the folders that are marked.
"""

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage


@dataclass
class Staged(WriterCommitMessage):
    """A task's file, none if it had no rows."""

    name: str | None
    rows: int


def _target(address: str):
    from pyarrow import fs

    address = address.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(address if ":" in address else f"file://{address}")


class JsonFolderWriter(DataSourceStreamArrowWriter):
    def __init__(self, address: str):
        self.address = address

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, root = _target(self.address)
        name, rows, out = f"{uuid.uuid4().hex}.json", 0, None
        for batch in iterator:
            if out is None:
                store.create_dir(f"{root}/staged", recursive=True)
                out = store.open_output_stream(f"{root}/staged/{name}")
            for row in batch.to_pylist():
                out.write((json.dumps(row, default=str) + "\n").encode())
            rows += batch.num_rows
        if out is None:
            return Staged(None, 0)
        out.close()
        return Staged(name, rows)

    def commit(self, messages: list, batchId: int) -> None:
        store, root = _target(self.address)
        folder = f"{root}/batch={batchId}"
        if self._whole(store, folder):
            return self.abort(messages, batchId)
        store.create_dir(folder, recursive=True)
        for m in messages:
            if m is not None and m.name:
                store.move(f"{root}/staged/{m.name}", f"{folder}/{m.name}")
        with store.open_output_stream(f"{folder}/_whole") as out:
            names = [m.name for m in messages if m is not None and m.name]
            out.write(json.dumps({"files": names, "rows": sum(m.rows for m in messages if m is not None)}).encode())

    def abort(self, messages: list, batchId: int) -> None:
        store, root = _target(self.address)
        for m in messages:
            if m is not None and m.name:
                store.delete_file(f"{root}/staged/{m.name}")

    def _whole(self, store, folder: str) -> bool:
        from pyarrow import fs

        return store.get_file_info(f"{folder}/_whole").type == fs.FileType.File


class JsonFolder(DataSource):
    """Sink ``json_folder``; option ``path`` is the target's address."""

    @classmethod
    def name(cls) -> str:
        return "json_folder"

    def streamWriter(self, schema, overwrite: bool) -> JsonFolderWriter:
        return JsonFolderWriter(self.options["path"])


def whole_files(address: str) -> list[str]:
    """The files of all batches that are whole, as their marks name them."""
    from pyarrow import fs

    store, root = _target(address)
    found = []
    for folder in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        mark = f"{folder.path}/_whole"
        if folder.type == fs.FileType.Directory and store.get_file_info(mark).type == fs.FileType.File:
            with store.open_input_stream(mark) as source:
                found += [f"{folder.path}/{n}" for n in json.loads(source.read())["files"]]
    return sorted(found)
