"""Overwriting listed paths from a template folder, all of them or none. Everything is validated before anything is moved."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from chroniq.plans.contract import RESET_LIST

#: What marks a campaign's root (fixed values).
ROOT_FILES = ("MANIFEST.md", "CURRENT.md")


class ResetError(ValueError):
    pass


def reset(spark: SparkSession, root: str, confirm: bool = False) -> list[str]:
    """Replace each listed path below ``root`` by its template; returns the paths. Only listed paths change.

    The list's items are taken line by line, with blanks around them and comments dropped. An empty, absolute or
    climbing path, a missing template or a missing confirmation raises before any change. The templates are copied beside the root first and
    compared with what they were copied from; then each path is moved away and its copy moved in its place. A failure midway moves
    all that was moved back, so the old state is whole.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = lambda *p: jvm.org.apache.hadoop.fs.Path("/".join(p))
    fs = at(root).getFileSystem(conf)
    for name in (*ROOT_FILES, RESET_LIST):
        if not fs.exists(at(root, name)):
            raise ResetError(f"no {name} below {root}")
    stream = fs.open(at(root, RESET_LIST))
    try:
        text = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()
    paths = [x.strip() for x in text.splitlines() if x.strip() and not x.strip().startswith("#")]
    if not paths:
        raise ResetError("the list is empty")
    for p in paths:
        if p.startswith("/") or p == "." or ".." in p.split("/"):
            raise ResetError(f"unsafe path {p!r}")
        if not fs.exists(at(root, "templates", p)):
            raise ResetError(f"no template for {p!r}")
    if not confirm:
        raise ResetError("not confirmed")
    work = f"{root.rstrip('/')}.reset-{uuid.uuid4().hex}"
    new, old, moved = f"{work}/new", f"{work}/old", []
    size = lambda p: (s := fs.getContentSummary(p)) and (s.getLength(), s.getFileCount())

    def move(a, b) -> None:
        fs.mkdirs(b.getParent())
        if not fs.rename(a, b):
            raise ResetError(f"cannot move {a} to {b}")

    try:
        for p in paths:
            fs.mkdirs(at(new, p).getParent())
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, at(root, "templates", p), fs, at(new, p), False, True, conf)
            if size(at(root, "templates", p)) != size(at(new, p)):
                raise ResetError(f"incomplete copy of {p!r}")
        for p in paths:
            for a, b in ((at(root, p), at(old, p)), (at(new, p), at(root, p))):
                if fs.exists(a):
                    move(a, b)
                    moved.append((a, b))
    except Exception:
        for a, b in reversed(moved):
            move(b, a)
        raise
    finally:
        fs.delete(at(work), True)
    return paths
