"""Outputs of a stage that appear all at once.

A stage writes into a generation of its own, a fresh folder that no reader looks
at. When everything is written, the manifest of the output folder is replaced by
one that names the new generation; readers follow it. A stage that fails leaves
the manifest, and with it the outputs that were there before.

Replaced generations stay for readers that have opened them, and go when the
next stage publishes.
"""

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MANIFEST = "_published.json"
GENERATIONS = "generations"
#: Levels above a table at which a manifest may lie.
_LEVELS = 3


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def manifest(spark: SparkSession, folder: str) -> dict:
    """``entries`` (generation of each output) and ``retired`` generations of a folder."""
    system, target = _system(spark, folder), _path(spark, f"{folder}/{MANIFEST}")
    if not system.exists(target):
        return {"entries": {}, "retired": []}
    stream = system.open(target)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _replace(spark: SparkSession, folder: str, content: dict) -> None:
    """Writes the manifest beside its place and moves it there in one step."""
    jvm = spark.sparkContext._jvm
    written = _path(spark, f"{folder}/{MANIFEST}.{uuid.uuid4().hex}")
    stream = _system(spark, folder).create(written)
    try:
        stream.write(json.dumps(content).encode())
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        written.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(written, _path(spark, f"{folder}/{MANIFEST}"), options)


@contextmanager
def publication(spark: SparkSession, folder: str) -> Iterator[str]:
    """A folder to write outputs to; they are published where the block ends well.

    Outputs are the names directly below it. Others of ``folder`` stay as they are.
    Two stages that publish the same outputs must not run at once.
    """
    folder = folder.rstrip("/")
    generation = uuid.uuid4().hex
    staged, system = f"{folder}/{GENERATIONS}/{generation}", _system(spark, folder)
    try:
        yield staged
    except BaseException:
        system.delete(_path(spark, staged), True)
        raise
    names = [status.getPath().getName() for status in system.listStatus(_path(spark, staged))]
    before = manifest(spark, folder)
    entries = before["entries"] | dict.fromkeys(names, generation)
    replaced = sorted(set(before["entries"].values()) - set(entries.values()))
    _replace(spark, folder, {"entries": entries, "retired": replaced})
    for old in set(before["retired"]) - set(entries.values()):
        system.delete(_path(spark, f"{folder}/{GENERATIONS}/{old}"), True)


def published(spark: SparkSession, path: str) -> str:
    """Where the output at ``path`` lies: in its current generation, or there as it says."""
    parts = path.rstrip("/").split("/")
    for up in range(1, min(_LEVELS, len(parts) - 1) + 1):
        folder, rest = "/".join(parts[:-up]), parts[-up:]
        if not folder or folder.endswith(":"):
            break
        generation = manifest(spark, folder)["entries"].get(rest[0])
        if generation:
            return "/".join([folder, GENERATIONS, generation, *rest])
    return path
