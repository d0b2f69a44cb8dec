"""Answer files: rows by query type, at most 100 a query, CSV text, and a checked archive."""

from __future__ import annotations

import csv
import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import clean_answer, clean_frame_idx, clean_video_id

MOST_ROWS, FOLDER = 100, "submission"


def query_kind(name: Column) -> Column:
    low = F.lower(name)
    return F.when(low.contains("qa"), "QA").when(low.contains("trake"), "TRAKE").otherwise("KIS")


def kis_row(video: Column, frame: Column) -> Column:
    return F.array(clean_video_id(video), clean_frame_idx(frame).cast("string"))


def qa_row(video: Column, frame: Column, answer: Column) -> Column:
    return F.concat(kis_row(video, frame), F.array(clean_answer(answer)))


def trake_row(video: Column, frames: Column) -> Column:
    """frames: an array of numbers or strings."""
    return F.concat(F.array(clean_video_id(video)), F.transform(frames, lambda f: clean_frame_idx(f).cast("string")))


def answer_rows(hits: DataFrame, names: DataFrame) -> DataFrame:
    """hits (qid, rank, video_id, frame_idx, text, entities), names (qid, name) -> (name, rank, fields) of at most 100 rows a query."""
    rows = hits.where(F.col("rank") <= MOST_ROWS).join(names, "qid")
    answer = F.coalesce(F.get("entities", F.lit(0)).value, F.substring("text", 1, 30))
    kind = query_kind(F.col("name"))
    fields = F.when(kind == "QA", qa_row(F.col("video_id"), F.col("frame_idx"), answer)).when(kind == "TRAKE", trake_row(F.col("video_id"), F.array("frame_idx"))).otherwise(kis_row(F.col("video_id"), F.col("frame_idx")))
    return rows.select("name", "rank", fields.alias("fields"))


def csv_line(fields: Column) -> Column:
    """Fields quoted only where they must be."""
    quoted = F.transform(fields, lambda v: F.when(v.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v))
    return F.array_join(quoted, ",")


def csv_text(rows: list[list]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows[:MOST_ROWS])
    return out.getvalue()


def save_csv(rows: list[list], path: str) -> str:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(csv_text(rows), encoding="utf-8")
    return path


def package(answers: dict[str, list[list] | str], path: str) -> str:
    """Write the archive: rows become CSV text, existing files go in as they are, paths that do not exist are left out."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, what in answers.items():
            entry = f"{FOLDER}/{name if name.endswith('.csv') else name + '.csv'}"
            if isinstance(what, list):
                z.writestr(entry, csv_text(what))
            elif Path(what).exists():
                z.write(what, entry)
    return path


def package_hits(rows: DataFrame, path: str) -> str:
    """Archive of answer_rows; a query has at most 100 short rows, so the driver holds what the archive holds."""
    found: dict[str, list[list]] = {}
    for r in rows.orderBy("name", "rank").toLocalIterator():
        found.setdefault(r["name"], []).append(list(r["fields"]))
    return package(found, path)


def validate(path: str) -> tuple[bool, list[str]]:
    """Whether an archive is one of answers, and what is wrong with it."""
    try:
        with zipfile.ZipFile(path) as z:
            names = [n for n in z.namelist() if not n.endswith("/")]
            wrong = [f"{n}: not in {FOLDER}/" for n in names if not n.startswith(f"{FOLDER}/")]
            good = [n for n in names if n.startswith(f"{FOLDER}/") and n.endswith(".csv")]
            if not good:
                wrong.append(f"no {FOLDER}/*.csv")
            for n in good:
                lines = [x for x in z.read(n).decode("utf-8").splitlines() if x.strip()]
                if len(lines) > MOST_ROWS:
                    wrong.append(f"{n}: {len(lines)} rows, {MOST_ROWS} are allowed")
    except (OSError, zipfile.BadZipFile, UnicodeDecodeError) as e:
        return False, [f"unreadable: {e}"]
    return not wrong, wrong
