"""Page layout: space sharing, oversize and tall boxes, reading order, columns, confidences, zones, line votes."""

from __future__ import annotations

from math import cos, pi, sin

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from polyscribe.functions import geometry as G
from polyscribe.functions.chars import GREEK, script_share
from polyscribe.operators.words import page_title


def share_spaces(words: DataFrame) -> DataFrame:
    """Each space between two words gives a third of the gap, 5 at most, to the word before and, 7 at most, to the one after, and goes.

    Where no space has a space beside it, one window a line does it. Lines with runs of spaces are folded from left to
    right, as later spaces see what earlier ones changed: the first word of such a line brings all of its words.
    """
    line = Window.partitionBy("page_id", "line_no").orderBy("word_no")
    space = F.col("text") == " "
    w = words.withColumn("_space", F.coalesce(space, F.lit(False)))
    w = w.withColumn("_run", F.col("_space") & F.coalesce(F.lag("_space").over(line), F.lit(False)))
    w = w.withColumn("_runs", F.max("_run").over(Window.partitionBy("page_id", "line_no")))
    w = w.withColumns({"_p": F.lag("_space").over(line), "_n": F.lead("_space").over(line), "_l": F.lag("bbox").over(line), "_r": F.lead("bbox").over(line)})
    w = w.withColumns({"_l2": F.lag("bbox", 2).over(line), "_r2": F.lead("bbox", 2).over(line)})
    third = lambda left, right: ((right - left) / 3).cast("int")
    x1 = F.when(F.col("_n") & F.col("_r2").isNotNull(), F.col("bbox.x1") + F.least(third(F.col("bbox.x1"), F.col("_r2.x0")), F.lit(5))).otherwise(F.col("bbox.x1"))
    x0 = F.when(F.col("_p") & F.col("_l2").isNotNull(), F.col("bbox.x0") - F.least(third(F.col("_l2.x1"), F.col("bbox.x0")), F.lit(7))).otherwise(F.col("bbox.x0"))
    box = F.struct(x0.cast("int").alias("x0"), F.col("bbox.y0").alias("y0"), x1.cast("int").alias("x1"), F.col("bbox.y1").alias("y1"))
    columns = [c for c in words.columns if c not in ("page_id", "line_no")]
    order = ["word_no", *[c for c in columns if c != "word_no"]]
    whole = Window.partitionBy("page_id", "line_no").orderBy("word_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("_w", F.collect_list(F.when(F.col("_runs"), F.struct(*order))).over(whole)).withColumn("_first", F.row_number().over(line))
    # the box is the one that a line without runs takes; one struct a word, so that a single pass serves both kinds of lines
    own = F.array(F.struct(*[(box if c == "bbox" else F.col(c)).alias(c) for c in order]))
    out = w.select("page_id", "line_no", F.when(~F.col("_runs"), F.when(~F.col("_space"), own)).when(F.col("_first") == 1, _folded(F.col("_w"))).alias("_out"))
    return out.select("page_id", "line_no", F.explode("_out").alias("_x")).select(*[F.col(c) if c in ("page_id", "line_no") else F.col(f"_x.{c}").alias(c) for c in words.columns])


def _folded(line: Column) -> Column:
    """The words of a line (in order) once all of its spaces are shared out, one after the other, and gone."""
    n = F.size(line)

    def step(done, i):
        here = F.get(done, i)
        before, after = F.get(done, i - 1)["bbox"], F.get(done, i + 1)["bbox"]
        acts = (here["text"] == " ") & (i > 0) & (i < n - 1)
        third = ((after["x0"] - before["x1"]) / 3).cast("int")
        left = lambda x: x.withField("bbox", x["bbox"].withField("x1", (before["x1"] + F.least(third, F.lit(5))).cast("int")))
        right = lambda x: x.withField("bbox", x["bbox"].withField("x0", (after["x0"] - F.least(third, F.lit(7))).cast("int")))
        changed = F.transform(done, lambda x, k: F.when(k == i - 1, left(x)).when(k == i + 1, right(x)).otherwise(x))
        return F.when(F.coalesce(acts, F.lit(False)), changed).otherwise(done)

    folded = F.aggregate(F.sequence(F.lit(0), n - 1), line, step)
    return F.filter(folded, lambda x: F.coalesce(x["text"] != " ", F.lit(True)))


def edge_words_to_borders(words: DataFrame, lines: DataFrame) -> DataFrame:
    """First and last words of a line stretched to one short of the line's box (lines: page_id, line_no, line_box)."""
    line = Window.partitionBy("page_id", "line_no")
    joined = words.join(lines.select("page_id", "line_no", "line_box"), ["page_id", "line_no"], "left").withColumns({"_a": F.min("word_no").over(line), "_z": F.max("word_no").over(line)})
    has = F.col("line_box").isNotNull()
    box = F.struct(
        F.when(has & (F.col("word_no") == F.col("_a")), F.col("line_box.x0") + 1).otherwise(F.col("bbox.x0")).alias("x0"), F.col("bbox.y0").alias("y0"),
        F.when(has & (F.col("word_no") == F.col("_z")), F.col("line_box.x1") - 1).otherwise(F.col("bbox.x1")).alias("x1"), F.col("bbox.y1").alias("y1"),
    )
    return joined.withColumn("bbox", box).drop("line_box", "_a", "_z")


def without_oversize(words: DataFrame, page_area: Column) -> DataFrame:
    """Words of at most a third of the page's area."""
    return words.filter(~F.coalesce(G.area(F.col("bbox")) > page_area / 3, F.lit(False)))


def tall_bars(components: DataFrame, least_ratio: int = 6, times_median: float = 1.5) -> DataFrame:
    """Components (page_id, w, h) whose height is over six whole times the width and over 1.5 times the page's median height."""
    median = components.groupBy("page_id").agg(F.median("h").alias("_median"))
    return components.join(median, "page_id").filter(F.expr(f"w > 0 AND h div w > {least_ratio}") & (F.col("h") > times_median * F.col("_median"))).drop("_median")


def column_rules(components: DataFrame, margin: int = 50) -> DataFrame:
    """Components that are column rules, with the ends of the line drawn over them."""
    rule = components.filter((F.col("h") > 50) & (F.col("x0") > 800) & (F.col("w") > 0) & (F.col("h") / F.col("w") > 10))
    return rule.withColumns({"from_y": F.col("y0") - margin, "to_y": F.col("y0") + F.col("h") + margin})


def big_fragments(components: DataFrame, times_median: float = 5) -> DataFrame:
    median = components.groupBy("page_id").agg(F.median("h").alias("_median"))
    return components.join(median, "page_id").filter(F.col("h") > times_median * F.col("_median")).drop("_median")


def between_lines(components: DataFrame, left: tuple[float, float, float, float], right: tuple[float, float, float, float]) -> DataFrame:
    """Components whose centre lies strictly between two slanted lines, each given as (x at the top, top y, x at the bottom, bottom y)."""
    cx, cy = F.col("x0") + F.col("w") / 2.0, F.col("y0") + F.col("h") / 2.0
    at = lambda s: s[0] + (cy - s[1]) * (s[2] - s[0]) / (s[3] - s[1])
    return components.filter((cx > at(left)) & (cx < at(right)))


def reading_order(lines: DataFrame, column_width: int = 600, ties: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """Lines (page_id, bbox) with reading_no: by column of ``column_width``, then from top to bottom, then as they stood."""
    key = [G.bucket(F.coalesce(F.col("bbox.x0"), F.lit(-1)), column_width), F.coalesce(F.col("bbox.y0"), F.lit(-1)), *[F.col(t) for t in ties]]
    return lines.withColumn("reading_no", F.row_number().over(Window.partitionBy("page_id").orderBy(*key)))


def line_boxes(words: DataFrame) -> DataFrame:
    """page_id, line_no, bbox, n_words: the box around each line's words."""
    return words.groupBy("page_id", "line_no").agg(G.union_box(F.col("bbox")).alias("bbox"), F.count("*").alias("n_words"))


def column_modes(lines: DataFrame, x_step: int = 40, length_step: int = 20) -> DataFrame:
    """Per page: the two commonest scaled starts and ends (ties: the smaller), the commonest scaled length, and the lowest edge."""
    measures = F.array(
        F.struct(F.lit("start").alias("k"), G.bucket(F.col("bbox.x0"), x_step).alias("v")), F.struct(F.lit("end").alias("k"), G.bucket(F.col("bbox.x1"), x_step).alias("v")),
        F.struct(F.lit("length").alias("k"), G.bucket(F.col("bbox.x1") - F.col("bbox.x0"), length_step).alias("v")),
    )
    counted = lines.select("page_id", F.explode(measures).alias("m")).groupBy("page_id", "m.k", "m.v").agg(F.count("*").alias("n"))
    ranked = counted.withColumn("_r", F.row_number().over(Window.partitionBy("page_id", "k").orderBy(F.desc("n"), "v"))).filter("_r <= 2")
    pick = lambda k, r: F.max(F.when((F.col("k") == k) & (F.col("_r") == r), F.col("v")))
    modes = ranked.groupBy("page_id").agg(pick("start", 1).alias("start_1"), pick("start", 2).alias("start_2"), pick("end", 1).alias("end_1"), pick("end", 2).alias("end_2"), pick("length", 1).alias("length_1"))
    return modes.join(lines.groupBy("page_id").agg(F.max("bbox.y1").alias("page_bottom")), "page_id")


def split_columns(words: DataFrame, lines: DataFrame, script: str = GREEK, least: float = 0.7) -> DataFrame:
    """Words with line_no changed where a line ran over two columns of different script; new lines follow the page's last.

    A line 1.3 times longer than the commonest length is cut at that length; its right part becomes a line of its own if
    the parts' shares of the script differ by more than ``least``.
    """
    modes = column_modes(lines).select("page_id", "length_1")
    wide = lines.join(modes, "page_id").filter((G.bucket(F.col("bbox.x1"), 20)) > ((1.3 * F.col("length_1")).cast("int") + F.col("bbox.x0") / 20))
    edge = wide.select("page_id", "line_no", (F.col("length_1") * 20 + F.col("bbox.x0")).alias("_edge"))
    sided = words.join(edge, ["page_id", "line_no"], "left").withColumn("_right", F.coalesce(G.centre_x(F.col("bbox")) >= F.col("_edge"), F.lit(False)))
    line = ["page_id", "line_no"]
    side = lambda right: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_right") == right, F.struct("word_no", "text")))), lambda x: x["text"]), "")
    parts = sided.filter("_edge IS NOT NULL").groupBy(*line).agg(side(F.lit(False)).alias("_l"), side(F.lit(True)).alias("_r"))
    differ = F.abs(script_share(F.col("_l"), script) - script_share(F.col("_r"), script)) > least
    cut = parts.filter((F.col("_l") != "") & (F.col("_r") != "") & differ).select(*line)
    last = lines.groupBy("page_id").agg(F.max("line_no").alias("_last"))
    fresh = cut.withColumn("_k", F.row_number().over(Window.partitionBy("page_id").orderBy("line_no"))).join(last, "page_id").select(*line, (F.col("_last") + F.col("_k")).alias("_new"))
    moved = sided.join(fresh, line, "left")
    return moved.withColumn("line_no", F.when(F.col("_right") & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col("line_no")).cast("int")).select(*words.columns)


def repair_two_columns(words: DataFrame, script: str = GREEK) -> DataFrame:
    """Words after column splitting, with the reading_no of their lines."""
    split = split_columns(words, line_boxes(words), script)
    order = reading_order(line_boxes(split)).select("page_id", "line_no", "reading_no")
    return split.join(order, ["page_id", "line_no"])


def confidence_summary(words: DataFrame, column: str = "confs") -> DataFrame:
    """words with min_confidence and average_confidence, to two places; null where there are none."""
    values = F.transform(F.col(column), lambda v: v.cast("double"))
    mean = F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / F.size(values)
    some = F.size(F.coalesce(values, F.array().cast("array<double>"))) > 0
    return words.withColumns({"min_confidence": F.when(some, F.round(F.array_min(values), 2)), "average_confidence": F.when(some, F.round(mean, 2))})


def clean_page_words(words: DataFrame, page_area: Column, file_name: Column | None = None) -> DataFrame:
    """The clean-up of line-recogniser output: oversize words go, spaces are shared out, confidences are summed up, and with a file name the page's title names its image."""
    out = confidence_summary(share_spaces(without_oversize(words, page_area)))
    return out if file_name is None else out.withColumn("page_title", page_title(F.col("page_title"), file_name))


def merge_boxes(components: DataFrame, gap: int, line: tuple[str, ...] = ("page_id", "line_no")) -> DataFrame:
    """(page_id, line_no, box_no, n, x0, y0, x1, y1): the components of a line joined to words where no more than ``gap`` lies between them."""
    along = Window.partitionBy(*line).orderBy("x0", (F.col("x0") + F.col("w")))
    reach = F.max(F.col("x0") + F.col("w")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    marked = components.withColumn("_starts", F.when(F.col("x0") <= reach + gap, 0).otherwise(1))
    numbered = marked.withColumn("box_no", (F.sum("_starts").over(along.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("int"))
    return numbered.groupBy(*line, "box_no").agg(F.count("*").alias("n"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max(F.col("x0") + F.col("w")).alias("x1"), F.max(F.col("y0") + F.col("h")).alias("y1"))


def nearest_classes(rows: DataFrame, samples: DataFrame, features: list[str], k: int = 3, most_samples: int = 10_000, slack: float = 1.2) -> DataFrame:
    """rows with ``nearest`` (distance to the closest sample) and ``label``: the commonest of the k nearest samples', null if too far.

    ``samples`` has sample_id, label and the features, and no more than ``most_samples`` rows, so that it can go to every task as one value;
    those that lack a feature are left out. Too far is over ``slack`` times the largest distance from a sample to the sample nearest to it.
    Ties: the smaller sample_id, the smaller label. Distances are taken in Arrow batches, some 60,000 at a time.
    """
    held = samples.select("sample_id", "label", *[F.col(c).cast("double").alias(c) for c in features]).limit(most_samples + 1).collect()
    if len(held) > most_samples:
        raise ValueError(f"more than {most_samples} samples")
    held = sorted((r for r in held if None not in r[2:]), key=lambda r: r[0])
    points = np.array([r[2:] for r in held], dtype=float).reshape(-1, len(features))
    labels = sorted({str(r[1]) for r in held})
    codes = np.array([labels.index(str(r[1])) for r in held], dtype=np.int64)
    own = [_squares(points[i : i + 1], points) for i in range(len(points) if len(points) > 1 else 0)]
    for i, d in enumerate(own):
        d[0, i] = np.inf
    limit = slack * np.sqrt(max(d.min() for d in own)) if own else np.inf
    least = min(k, len(held))

    def classified(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = np.sqrt(_squares(values, points))
        near = np.empty((len(values), least), dtype=np.int64)
        each = np.arange(len(values))
        for j in range(least):
            near[:, j] = d.argmin(axis=1)  # the first of equals: samples are in order of their ids
            if j == 0:
                nearest = d[each, near[:, 0]]
            d[each, near[:, j]] = np.inf
        of = codes[near]
        votes = (of[:, :, None] == of[:, None, :]).sum(axis=2) * (len(labels) + 1) - of
        return nearest, of[each, votes.argmax(axis=1)]

    def classify(batches):
        names = np.array(labels, dtype=object)
        step = max(1, 60_000 // max(1, len(held)))
        for batch in batches:
            n = batch.num_rows
            kept, wanted = batch.columns[: -len(features)], batch.columns[-len(features) :]
            lacking = np.logical_or.reduce([c.is_null().to_numpy(zero_copy_only=False) for c in wanted]) | (not held)
            values = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in wanted], axis=1)
            nearest, label = np.zeros(n), np.zeros(n, dtype=np.int64)
            for i in range(0, n if held else 0, step):
                nearest[i : i + step], label[i : i + step] = classified(values[i : i + step])
            text = names[label] if held else np.full(n, None, dtype=object)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(nearest, mask=lacking), pa.array(text, pa.string(), mask=lacking | ~(nearest <= limit))], names=[*batch.schema.names[: -len(features)], "nearest", "label"])

    asked = rows.select(*rows.columns, *[F.col(c).cast("double").alias(f"_feature{i}") for i, c in enumerate(features)])
    return asked.mapInArrow(classify, StructType([*rows.schema.fields, StructField("nearest", DoubleType()), StructField("label", StringType())]))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of a and those of b, feature after feature."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        d = b[:, j] - a[:, j, None]
        out += d * d
    return out


def contiguous_run(rows: DataFrame, group: list[str], order: list[str], ok: Column) -> DataFrame:
    """The rows of each group before its first one that is not ok."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("_bad", F.sum(F.when(F.coalesce(ok, F.lit(False)), 0).otherwise(1)).over(w)).filter("_bad = 0").drop("_bad")


def after_first(rows: DataFrame, group: list[str], order: list[str], match: Column, out: str = "after") -> DataFrame:
    """rows with a flag that holds after the first match of their group."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(out, F.coalesce(F.max(F.coalesce(match, F.lit(False))).over(w), F.lit(False)))


def title_band(components: DataFrame, centre: Column) -> DataFrame:
    """Components of a page's head: from the topmost one over the centre outwards to either side while they overlap it in y."""
    over = (F.col("x0") <= centre) & (F.col("x0") + F.col("w") >= centre)
    seed = components.filter(over).groupBy("page_id").agg(F.min(F.struct("y0", "x0", "w", "h")).alias("_s"))
    joined = components.join(seed, "page_id")
    overlap = (F.col("y0") <= F.col("_s.y0") + F.col("_s.h")) & (F.col("y0") + F.col("h") >= F.col("_s.y0"))
    right = F.col("x0") >= F.col("_s.x0")
    sided = joined.withColumns({"_right": right, "_d": F.when(right, F.col("x0")).otherwise(-F.col("x0"))})
    return contiguous_run(sided, ["page_id", "_right"], ["_d", "y0"], overlap).select(*components.columns)


def footnote_regions(components: DataFrame, region: Column, centre: Column) -> DataFrame:
    """Components with ``footnote``: whether they come, by y, after the first one inside the region (a box) that straddles the centre."""
    inside = (F.col("x0") >= region["x0"]) & (F.col("y0") >= region["y0"]) & (F.col("x0") + F.col("w") <= region["x1"]) & (F.col("y0") + F.col("h") <= region["y1"])
    straddles = (F.col("x0") < centre) & (F.col("x0") + F.col("w") > centre)
    return after_first(components, ["page_id"], ["y0", "x0"], inside & straddles, "footnote")


#: Cells of a page's accumulator, over a few for each vote, up to which it is held as a table, else as a sorted list of its cells.
TABLE_CELLS = 100_000


def _peaks(x: np.ndarray, y: np.ndarray, turns: list[tuple[float, float]], step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """radius_no, angle_no and votes of the cells that none of their four neighbours has more votes than."""
    radius = np.stack([np.floor((x * c + y * s) / step).astype(np.int64) for c, s in turns])
    low, wide, high = radius.min(), len(turns) + 2, int(radius.max() - radius.min()) + 3
    keys = ((radius - low + 1) * wide + np.arange(1, len(turns) + 1)[:, None]).ravel()
    if wide * high <= TABLE_CELLS + 16 * len(keys):
        table = np.bincount(keys, minlength=wide * high).reshape(high, wide)
        inner = table[1:-1, 1:-1]
        near = np.maximum(np.maximum(table[:-2, 1:-1], table[2:, 1:-1]), np.maximum(table[1:-1, :-2], table[1:-1, 2:]))
        r, a = np.nonzero((inner > 0) & (inner >= near))
        return r + low, a, inner[r, a]
    cells, votes = np.unique(keys, return_counts=True)
    near = np.zeros(len(cells), dtype=votes.dtype)
    for shift in (1, -1, wide, -wide):
        at = np.minimum(np.searchsorted(cells, cells + shift), len(cells) - 1)
        near = np.maximum(near, np.where(cells[at] == cells + shift, votes[at], 0))
    top = votes >= near
    return cells[top] // wide - 1 + low, cells[top] % wide - 1, votes[top]


def line_votes(points: DataFrame, angles: int = 40, radius_step: int = 4, spread: float = 0.2, count: int | None = None, apart: int = 10) -> DataFrame:
    """(page_id, radius_no, angle_no, votes): straight lines near the vertical through points (page_id, x, y), as local maxima of an accumulator.

    Each point votes once an angle, and a cell stays if none of its four neighbours has more. Points are gathered by page, and a page's
    accumulator lives in one task: votes are never rows. With ``count``, only what ``best_lines`` would take is returned, with its rank.
    """
    turn = [(a - (angles - 1) / 2.0) / angles * spread * pi for a in range(angles)]
    turns = [(cos(t), sin(t)) for t in turn]
    schema = StructType([StructField("page_id", points.schema["page_id"].dataType), *([StructField("rank", IntegerType())] if count else []), StructField("radius_no", IntegerType()), StructField("angle_no", IntegerType()), StructField("votes", LongType())])

    def vote(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r, a, n = _peaks(batch.column(1)[i].values.to_numpy(zero_copy_only=False), batch.column(2)[i].values.to_numpy(zero_copy_only=False), turns, radius_step)
                columns = []
                if count:
                    order, taken = np.lexsort((a, r, -n)), []
                    while len(order) and len(taken) < count:
                        taken.append(order[0])
                        order = order[np.abs(r[order] - r[order[0]]) >= apart]
                    r, a, n = r[taken], a[taken], n[taken]
                    columns = [pa.array(np.arange(len(taken)), pa.int32())]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.full(len(r), i))), *columns, pa.array(r, pa.int32()), pa.array(a, pa.int32()), pa.array(n, pa.int64())], names=schema.names)

    placed = points.filter("x IS NOT NULL AND y IS NOT NULL").select("page_id", *[F.col(c).cast("double").alias(c) for c in "xy"])
    return placed.groupBy("page_id").agg(F.collect_list("x").alias("x"), F.collect_list("y").alias("y")).mapInArrow(vote, schema)


def best_lines(votes: DataFrame, count: int = 2, apart: int = 10) -> DataFrame:
    """Up to ``count`` lines a page: the strongest, then the strongest at least ``apart`` radius steps from those before."""
    listed = votes.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("o"), "radius_no", "angle_no", "votes"))).alias("_v"))
    empty = F.array().cast("array<struct<o:bigint,radius_no:int,angle_no:int,votes:bigint>>")
    pick = lambda done, v: F.when((F.size(done) < count) & F.forall(done, lambda d: F.abs(d["radius_no"] - v["radius_no"]) >= apart), F.concat(done, F.array(v))).otherwise(done)
    return listed.select("page_id", F.posexplode(F.aggregate("_v", empty, pick)).alias("rank", "_l")).select("page_id", "rank", "_l.radius_no", "_l.angle_no", "_l.votes")


def rejection_threshold(rows: DataFrame, column: str) -> DataFrame:
    """One row: 1.2 times the largest value."""
    return rows.agg((1.2 * F.max(column)).alias("threshold"))


def by_corner(boxes: DataFrame) -> DataFrame:
    return boxes.orderBy("text", "bbox.x1", "bbox.y1")


def from_top(components: DataFrame) -> DataFrame:
    return components.orderBy("page_id", "y0")
