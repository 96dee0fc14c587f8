"""Borehole logs from text boxes: depth scale, penetration counts, soils, hammer efficiency.

One report is one group; a printed log is bounded. Failures are rows (report, category), never exceptions: no_depth_label, no_depth_scale,
no_spt_values, depth_out_of_range.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit import constants as K
from stratakit.operators import load
from stratakit.schemas import conform
from stratakit.session import cut, salted_join

OUT = "report string, kind string, depth double, n int, soil_types array<string>, efficiency double, category string"


def depth_label(text: str) -> float | None:
    """A box's text as a depth between 0 and 60 m, or None."""
    t = text.strip(" \nm")
    if not re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", t):
        return None
    v = float(t)
    return v if 0 <= v <= K.MAX_SPT_DEPTH else None


def depth_scale(left: float, right: float, boxes: pd.DataFrame, beyond: float = 5.0, rounds: int = 10) -> tuple[float, float] | None:
    """(slope, intercept) of depth over height from the numbers in the column of a label that spans ``left`` to ``right``, or None.

    ``boxes`` come bottom to top. A number belongs to the column when its centre, give or take a band, meets the label's whole width. The
    band, at most half that width and ``beyond``, is searched by halving: too few numbers widen it, depths that rise upward narrow
    it. The first acceptable band counts.
    """
    read = [depth_label(t) for t in boxes["text"]]
    middle = zip(read, (boxes["y0"] + boxes["y1"]) / 2, (boxes["x0"] + boxes["x1"]) / 2)
    labels = [(d, y, x) for d, y, x in middle if d is not None]
    low, high = 0.0, beyond + (right - left) / 2
    for _ in range(rounds):
        eps = (low + high) / 2
        inside = [(d, y) for d, y, x in labels if left <= x + eps and x - eps <= right]
        if len(inside) < 2:
            low = eps
            continue
        d, y = np.array(inside).T
        if np.all(np.diff(d) > 0):
            high = eps
            continue
        if np.ptp(y) == 0:
            return None
        slope, intercept = np.polyfit(y, d, 1)
        return float(slope), float(intercept)
    return None


def _percent_near(label: re.Match, text: str) -> float | None:
    hits = [(max(abs(m.start() - label.start()), abs(m.end() - label.end())), m.start(), float(m.group(1))) for m in re.finditer(K.PERCENTAGE, text)]
    return min(hits)[2] if hits else None


def analyse_report(pdf: pd.DataFrame) -> pd.DataFrame:
    """The rows of one report: counts (kind spt), soils (kind soil), one efficiency, or one failure."""
    report = pdf["report"].iloc[0]
    boxes = pdf.dropna(subset=["text"]).sort_values(["page", "y0", "x0"], kind="stable")
    columns = [c.split()[0] for c in OUT.split(", ")]

    def failed(why: str) -> pd.DataFrame:
        return pd.DataFrame([(report, "failure", None, None, None, None, why)], columns=columns)

    label = boxes[boxes["text"].str.lower().str.match(K.DEPTH_LABEL)]
    if label.empty:
        return failed("no_depth_label")
    left, right = float(label["x0"].iloc[0]), float(label["x1"].iloc[0])
    out: list[tuple] = []
    efficiency, scaled = None, False
    for _, page in boxes.groupby("page", sort=True):
        for box in page.itertuples():
            if m := re.search(K.RATIO_LABEL, box.text):
                efficiency = _percent_near(m, box.text)
                if efficiency is None:
                    beside = [b.text for b in page.itertuples() if not (b.y1 < box.y0 or box.y1 < b.y0)]
                    found = [re.search(K.PERCENTAGE, t) for t in beside]
                    efficiency = next((float(f.group(1)) for f in found if f), None)
        fit = depth_scale(left, right, page)
        if fit is None:
            continue
        scaled = True
        for box in page.iloc[::-1].itertuples():
            depth = fit[0] * (box.y0 + box.y1) / 2 + fit[1]
            if m := re.search(K.SPT_VALUE, box.text):
                out.append((report, "spt", round(float(np.rint(depth / 0.25) * 0.25), 2), int(m.group(2)), None, None, None))
            soils = [s for s in K.SOIL_TYPES if s in {w.strip(",.;") for w in box.text.split()}]
            if soils:
                out.append((report, "soil", depth, None, soils, None, None))
    if not scaled:
        return failed("no_depth_scale")
    depths = [r[2] for r in out if r[1] == "spt"]
    if not depths:
        return failed("no_spt_values")
    if min(depths) < 0 or max(depths) > K.MAX_BOREHOLE_DEPTH:
        return failed("depth_out_of_range")
    out.append((report, "efficiency", None, None, None, efficiency, None))
    return pd.DataFrame(out, columns=columns)


def analyse(boxes: DataFrame) -> DataFrame:
    """All reports; see :data:`OUT`. ``boxes``: report, page, y0, y1, x0, x1, text."""
    need = boxes.where("report is not null").select("report", "page", "y0", "y1", "x0", "x1", "text")
    return need.groupBy("report").applyInPandas(analyse_report, OUT)


def allowed(df: DataFrame, key: str, allow: DataFrame) -> DataFrame:
    """Rows whose key is on the allow-list."""
    return df.join(allow.select(F.col(allow.columns[0]).alias(key)).distinct(), key, "left_semi")


def store_reports(spark: SparkSession, found: DataFrame, ids: DataFrame) -> dict[str, DataFrame]:
    """The store tables of analysed reports: sptreport, sptmeasurements, soilmeasurements and the bridge soilmeasurementsoiltype.

    ``found``: see :data:`OUT`; ``ids``: report, borehole_id (one id per report; a report without one is left out). A soil measurement is
    keyed after the report, the depth and the soils named there; a soil that the store does not know is left out of the bridge.
    """
    owned = salted_join(found.where("kind <> 'failure'"), ids.groupBy("report").agg(F.min("borehole_id").cast("int").alias("borehole_id")), ["report"], "inner", ["kind", "depth"])
    reports = owned.groupBy("borehole_id").agg(
        F.col("borehole_id").alias("nzgd_id"), F.max("efficiency").alias("efficiency"), F.element_at(F.split(F.min("report"), "/"), -1).alias("source_file")
    )
    counts = owned.where("kind = 'spt'").select("borehole_id", "depth", "n")
    soils = owned.where("kind = 'soil'").select(F.col("borehole_id").alias("report_id"), F.col("depth").alias("top_depth"), F.array_sort("soil_types").alias("soil_types"))
    soils = cut(load.surrogate_ids(soils, ["report_id", "top_depth", "soil_types"], "measurement_id"))
    named = soils.select(F.col("measurement_id").alias("soil_measurement_id"), F.explode("soil_types").alias("soil"))
    bridge = load.encode(named, "soil", load.constant_dimension(spark, K.SOIL_TYPES), "soil_type_id").where("soil_type_id is not null")
    return {
        "sptreport": conform(reports, "sptreport"),
        "sptmeasurements": conform(load.surrogate_ids(counts, ["borehole_id", "depth", "n"], "measurement_id"), "sptmeasurements"),
        "soilmeasurements": conform(soils, "soilmeasurements"),
        "soilmeasurementsoiltype": conform(bridge.distinct(), "soilmeasurementsoiltype"),
    }
