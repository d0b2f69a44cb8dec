"""Tools over a record table, for programs that ask one question at a time. Each answer is small and comes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.spatial import box
from . import documents as D, search as Q


class SceneTextTools:
    """records as in search and documents; index and sizes (of a written index) save building them for each search."""

    def __init__(self, records: DataFrame, index: DataFrame | None = None, sizes: DataFrame | None = None):
        self.records, self.index, self.sizes = records, index, sizes

    def _frame(self, video_id: str, frame_idx: int) -> DataFrame:
        return self.records.where((F.col("video_id") == video_id) & (F.col("frame_idx") == frame_idx))

    def tool_search_ocr(self, query_text: str, top_k: int = 20, entity_type: str | None = None) -> list[dict]:
        asked = self.records.sparkSession.createDataFrame([("q", query_text)], "qid string, query string")
        hits = Q.compact(Q.payloads(Q.search(self.records, asked, top_k, entity_type=entity_type, index=self.index, sizes=self.sizes)))
        return [r.asDict(True) for r in hits.orderBy("rank").drop("qid", "rank").collect()]

    def tool_read_frame_text(self, video_id: str, frame_idx: int) -> dict:
        out = {"video_id": video_id, "frame_idx": frame_idx, "total_detections": 0, "full_transcription": "", "detections": [], "extracted_entities": []}
        found = D.frame_answers(self._frame(video_id, frame_idx)).first()
        return out if found is None else out | found.asDict(True)

    def tool_inspect_roi(self, video_id: str, frame_idx: int, roi: list[float]) -> dict:
        """roi: ymin, xmin, ymax, xmax."""
        out = {"video_id": video_id, "frame_idx": frame_idx, "roi": roi, "matched_text": "", "detections": []}
        found = D.roi_answers(self._frame(video_id, frame_idx), box(*[F.lit(float(v)) for v in roi])).first()
        return out if found is None else out | found.asDict(True)

    def tool_extract_entities_in_video(self, video_id: str, entity_type: str | None = None) -> list[dict]:
        rows = D.entity_answers(self.records.where(F.col("video_id") == video_id), entity_type)
        return [r.asDict(True) for r in rows.orderBy("id", "pos").drop("id", "pos").collect()]

    @staticmethod
    def get_tool_schemas() -> list[dict]:
        return D.TOOL_SCHEMAS
