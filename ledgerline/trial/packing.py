"""Zip archives made from the documents, to have some to expand."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

MAIN = "TEXTCSV"
EXTRA = "LISTA"


def pack(documents: DataFrame, folder: str) -> str:
    """Archives ``K<first id>.TEXTCSV.zip`` below ``folder``: a member of the archive's name with every line of
    its documents behind the document's id, and one that lists the ids. Each task writes its own."""

    def write(batches):
        import io
        import zipfile

        import pyarrow as pa
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(place)
        system.create_dir(root, recursive=True)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            if not ids:
                continue
            name = f"K{ids[0]}.{MAIN}"
            raw = io.BytesIO()
            with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
                with archive.open(name, "w") as member:
                    for doc_id, body in zip(ids, batch.column("text").to_pylist()):
                        for line in body.split("\n"):
                            member.write(f"{doc_id}\t{line}\n".encode())
                archive.writestr(f"K{ids[0]}.{EXTRA}", "".join(f"{doc_id}\n" for doc_id in ids))
            with system.open_output_stream(f"{root}/{name}.zip") as out:
                out.write(raw.getvalue())
            yield pa.RecordBatch.from_pydict({"archive": [name]})

    place = re.sub("^file:/+", "/", folder)
    documents.select("doc_id", "text").mapInArrow(write, "archive string").count()
    return folder
