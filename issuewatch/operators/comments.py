"""Comments: C1 C2 C7 P5 A7 A9 W3 X3 (nested, per-row HOFs) and W1 W2 A10 (flat items).

Nested comment arrays are handled with higher-order functions inside one row, so no
grouping is involved. Thread assembly over flat items (one row per list item with its
list position `pos`, 0..n-1) avoids one-task-per-post windows: W1 uses a blocked
prefix scan (window inside (post, position block) + a carry per block), W2 an equi-join
on (post, pos + 1). A post that holds a third of all items is spread over its blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

REPLY = T.StructType([T.StructField(n, T.StringType()) for n in ("author", "content", "created_at")])
COMMENT = T.StructType(
    [
        T.StructField("author", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("num_of_comments", T.StringType()),
        T.StructField("children", T.ArrayType(REPLY)),
        T.StructField("liked", T.StringType()),  # clien
        T.StructField("modified_at", T.StringType()),  # clien
    ]
)
COMMENTS = T.ArrayType(COMMENT)
WRAPPED = T.ArrayType(T.StructType([T.StructField("comment", REPLY), T.StructField("children", T.ArrayType(REPLY))]))

POSITION_BLOCK = 4096  # items per block in the W1 prefix scan


def normalise_comments(raw_json: Column) -> Column:
    """One comment array from the three shapes (flat list; list of {comment,
    children}; null) -> array<COMMENT>, null -> []."""
    wrapped = F.get_json_object(raw_json, "$[0].comment").isNotNull()
    from_wrapped = F.transform(
        F.from_json(raw_json, WRAPPED),
        lambda w: F.struct(
            w["comment"]["author"].alias("author"),
            w["comment"]["content"].alias("content"),
            w["comment"]["created_at"].alias("created_at"),
            F.size(F.coalesce(w["children"], F.array())).cast("string").alias("num_of_comments"),
            F.coalesce(w["children"], F.array().cast(T.ArrayType(REPLY))).alias("children"),
            F.lit(None).cast("string").alias("liked"),
            F.lit(None).cast("string").alias("modified_at"),
        ),
    )
    parsed = F.when(wrapped, from_wrapped).otherwise(F.from_json(raw_json, COMMENTS))
    return F.coalesce(parsed, F.array().cast(COMMENTS))


def is_valid_time(c: Column) -> Column:
    """P5: a comment with blank created_at is a deleted one."""
    return F.length(F.trim(c)) > 0


def rewrite_comment_times(comments: Column, parse) -> Column:
    """created_at of each valid comment rewritten by `parse` (string -> timestamp)
    and formatted `yyyy-MM-dd HH:mm:ss`; deleted comments keep their blank value."""
    return F.transform(
        comments,
        lambda c: c.withField(
            "created_at",
            F.when(is_valid_time(c["created_at"]), F.date_format(parse(c["created_at"]), "yyyy-MM-dd HH:mm:ss")).otherwise(c["created_at"]),
        ),
    )


def comment_count(comments: Column) -> Column:
    """len(comments), null -> 0."""
    return F.coalesce(F.size(comments), F.lit(0))


def last_valid_comment_time(comments: Column) -> Column:
    """created_at of the last valid comment in list order (null if none)."""
    valid = F.filter(comments, lambda c: is_valid_time(c["created_at"]))
    return F.when(F.size(valid) > 0, F.element_at(valid, -1)["created_at"])


def seconds_per_comment(post_time: Column, last_time: Column, n: Column) -> Column:
    """Seconds part of (last comment - post) / n; 0 when n = 0; NULL when n > 0 but
    no valid comment (SURVEY D8)."""
    diff = F.pmod(F.timestamp_diff("SECOND", post_time, last_time), F.lit(86400))
    return F.when(n == 0, F.lit(0.0)).otherwise(diff.cast("double") / n.cast("double"))


def post_comment_rows(posts: DataFrame, key: str, parse, count: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """X3 (+C7, A7, A9, W3, P5): posts and their comments as one flat table, in one pass.

    posts: key, content, created_at (timestamp), viewed, liked, comments (array<COMMENT>).
    Each post row becomes an array of items - its valid comments (zeros for the
    counts) followed by the post itself (counts and seconds_per_comment) - exploded
    once. `item_order` sorts each post's comments before the post (row order of the CSV).
    `count` is the post's own number of comments where its site gives one (dc, naver);
    the array's length otherwise. `keep`: columns of the post to repeat on each row.
    """
    n = comment_count(F.col("comments")) if count is None else count
    last = parse(last_valid_comment_time(F.col("comments")))

    def item(order, content, created, viewed, liked, post_type, n_comments, spc):
        return F.struct(
            order.cast("int").alias("item_order"),
            content.alias("content"),
            created.alias("created_at"),
            viewed.cast("int").alias("viewed"),
            liked.cast("int").alias("liked"),
            F.lit(post_type).alias("post_type"),
            n_comments.cast("int").alias("num_of_comments"),
            spc.cast("double").alias("seconds_per_comment"),
        )

    zero = F.lit(0)
    valid = F.filter(F.transform(F.col("comments"), lambda c, i: F.struct(c.alias("c"), i.alias("i"))), lambda x: is_valid_time(x["c"]["created_at"]))
    comment_items = F.transform(valid, lambda x: item(x["i"], x["c"]["content"], parse(x["c"]["created_at"]), zero, zero, 1, zero, F.lit(0.0)))
    post_item = item(F.lit(2147483647), F.col("content"), F.col("created_at"), F.col("viewed"), F.col("liked"), 0, n, seconds_per_comment(F.col("created_at"), last, n))
    items = F.concat(comment_items, F.array(post_item))
    return posts.select(key, *keep, F.explode(items).alias("_it")).select(key, *keep, "_it.*")


def last_flag_position(items: DataFrame, key: str, pos: str, flag: Column, block: int = POSITION_BLOCK) -> DataFrame:
    """For each item, the largest position <= its own where `flag` holds, per key; items
    before the first flag take the key's first position. Blocked prefix scan: running
    max inside (key, block), plus the max of all earlier blocks of the key (computed on
    one row per block)."""
    it = items.withColumn("_flag", flag).withColumn("_blk", F.floor(F.col(pos) / F.lit(block)))
    w_in = Window.partitionBy(key, "_blk").orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    it = it.withColumn("_local", F.max(F.when(F.col("_flag"), F.col(pos))).over(w_in))
    per_block = it.groupBy(key, "_blk").agg(F.max(F.when(F.col("_flag"), F.col(pos))).alias("_bmax"), F.min(pos).alias("_bmin"))
    w_carry = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_block.select(key, "_blk", F.max("_bmax").over(w_carry).alias("_carry"), F.min("_bmin").over(Window.partitionBy(key)).alias("_first"))
    out = it.join(carry, [key, "_blk"], "left")
    return out.withColumn("flag_pos", F.coalesce("_local", "_carry", "_first")).drop("_flag", "_blk", "_local", "_carry", "_first")


def assemble_threads(items: DataFrame, key: str = "post", pos: str = "pos", is_reply: str = "is_reply") -> DataFrame:
    """thread_pos = position of the parent of each item (parents are non-replies; a
    post's first item is a parent itself, whatever its position, SURVEY D23)."""
    t = last_flag_position(items, key, pos, ~F.col(is_reply))
    return t.withColumnRenamed("flag_pos", "thread_pos").withColumn("is_parent", F.col("thread_pos") == F.col(pos))


#: Replies that one row of `nested_threads` holds at most.
THREAD_CHUNK = 1000


def nested_threads(items: DataFrame, key: str = "post", pos: str = "pos", is_reply: str = "is_reply", chunk: int = THREAD_CHUNK) -> DataFrame:
    """(key, thread_pos, chunk_no, n_chunks, parent, children): the threads with their replies
    nested, in list order. `parent` and `children` hold all columns but the key and the flag.

    A thread is a parent and the replies behind it, so a reply's place in it is its distance
    from the parent, and no ranking is needed. Up to `chunk` places are one row; a longer
    thread has several, numbered from 0, each with its parent, so that no task gathers a
    whole hot thread. A thread without replies has one row with no children. Positions may
    have gaps; chunks that they leave empty have no row."""
    t = assemble_threads(items, key, pos, is_reply)
    rest = [c for c in items.columns if c not in (key, is_reply)]
    threads = t.select(key, "thread_pos", F.floor((F.col(pos) - F.col("thread_pos") - 1) / chunk).alias("chunk_no"), F.col("is_parent").alias("_top"), F.struct(*rest).alias("_item"))
    replies = threads.where(~F.col("_top")).groupBy(key, "thread_pos", "chunk_no").agg(F.collect_list(F.struct(F.col("_item")[pos].alias("_at"), "_item")).alias("_all"))  # at most `chunk`
    replies = replies.select(key, "thread_pos", "chunk_no", F.transform(F.array_sort("_all"), lambda x: x["_item"]).alias("children"))
    sizes = replies.groupBy(key, "thread_pos").agg(F.count("*").alias("n_chunks"))
    parents = threads.where("_top").select(key, "thread_pos", F.col("_item").alias("parent")).join(sizes, [key, "thread_pos"], "left")
    both = parents.join(replies, [key, "thread_pos"], "left")
    none = F.array().cast(replies.schema["children"].dataType)
    return both.select(
        key, "thread_pos", F.coalesce("chunk_no", F.lit(0)).cast("long").alias("chunk_no"), F.coalesce("n_chunks", F.lit(1)).cast("long").alias("n_chunks"), "parent", F.coalesce("children", none).alias("children")
    )


def thread_reply_counts(threads: DataFrame, key: str = "post", pos: str = "pos") -> DataFrame:
    """A10: replies per parent (partial aggregation, so a hot thread is pre-summed)."""
    parents = threads.filter("is_parent").select(key, F.col(pos).alias("thread_pos"), *[c for c in threads.columns if c not in (key, pos, "thread_pos", "is_parent", "is_reply")])
    counts = threads.filter(~F.col("is_parent")).groupBy(key, "thread_pos").agg(F.count(F.lit(1)).alias("reply_count"))
    return parents.join(counts, [key, "thread_pos"], "left").fillna(0, ["reply_count"])


def replies_from_next(items: DataFrame, key: str, pos: str, count_col: str, payload: str) -> DataFrame:
    """An item whose reply count is > 0 takes its replies from the next item (dc
    layout). Equi-join on (key, pos + 1); the join key is unique, so no skew."""
    nxt = items.select(F.col(key), (F.col(pos) - 1).alias(pos), F.col(payload).alias("_next_payload"), F.col(pos).alias("_next_pos"))
    j = items.join(nxt, [key, pos], "left")
    take = F.col(count_col) > 0
    return j.withColumn("reply_pos", F.when(take, F.col("_next_pos"))).withColumn("replies", F.when(take, F.col("_next_payload"))).drop("_next_payload", "_next_pos")
