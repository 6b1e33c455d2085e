"""The line source: offsets, byte ranges, restart and replay."""

import pathlib
import shutil

from eventlens.session import scratch_path
from eventlens.sources import line_source
from eventlens.streaming import jobs


def _run(spark, root, timeout_s=60):
    lines = line_source.stream_lines(spark, f"{root}/in", f"{root}/progress/offset.json", files_per_trigger=2, split_bytes=16)
    return jobs.run_until_caught_up(jobs.to_parquet(lines, f"{root}/out"), f"{root}/ck", timeout_s)


def test_lines_arrive_once_over_restarts(spark):
    root = scratch_path(spark, "test/line-source")
    folder = pathlib.Path(root, "in")
    folder.mkdir(parents=True)
    texts = {f"f{k}": [f"line {k}-{i} é" + "x" * (i * 7 % 23) for i in range(k * 3)] + ["", "last"] for k in range(5)}
    for name, lines in texts.items():
        (folder / name).write_text("\n".join(lines) + ("\n" if name != "f2" else ""), encoding="utf-8")
    (folder / "_SUCCESS").write_text("no line")

    def got():
        rows = spark.read.parquet(f"{root}/out").orderBy("file", "at").collect()
        out = {}
        for r in rows:
            out.setdefault(r.file.rsplit("/", 1)[1], []).append(r.value)
        return out

    _run(spark, root)
    assert got() == texts
    batches = {p.name for p in pathlib.Path(root, "ck/commits").iterdir() if p.name.isdigit()}
    assert len(batches) == 3                                   # five files, two per trigger
    # a restart goes on behind what was read
    texts["f5"], texts["f6"] = ["new", "lines"], ["more"]
    for name in ("f5", "f6"):
        (folder / name).write_text("\n".join(texts[name]))
    _run(spark, root)
    assert got() == texts
    # the last trigger's commit is lost: it is run again over the same files, the sink takes it once
    last = max(int(p.name) for p in pathlib.Path(root, "ck/commits").iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        shutil.move(str(pathlib.Path(root, "ck/commits", name)), str(pathlib.Path(root, f"lost{name}")))
    _run(spark, root)
    assert got() == texts


def test_staged_files_are_bounded():
    from eventlens.plans import parsers
    assert parsers._line_files(0) == parsers._line_files(700_000) == 6
    for lines in (10**8, 10**9):
        assert lines / parsers._line_files(lines) <= parsers.LINES_PER_FILE
