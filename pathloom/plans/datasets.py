"""Queries over episode tables: grouping, splits, dictionaries, text, and grounded predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.functions import text
from pathloom.operators import datasets, folds, logic, pool, sampling
from pathloom.operators import quantifiers as quantifiers_
from pathloom.operators.prefix import running_before
from pathloom.plans.registry import query
from pathloom.plans.standins import FRAMES_SQL, episodes, frames, table

R = 6


@query("""WITH s AS (SELECT c_nationkey, min(c_custkey) AS group_start FROM customer GROUP BY ALL) SELECT c_custkey, c_nationkey, group_start FROM customer JOIN s USING (c_nationkey)""")
def scene_groups(spark, sf_dir):
    return datasets.first_seen_order(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", "c_custkey")


@query("""WITH h AS (SELECT c_custkey, c_nationkey, row_number() OVER (ORDER BY md5('seed7' || c_custkey), c_custkey) - 1 AS pos, (SELECT count(*) FROM customer) // 9 AS size FROM customer),
k AS (SELECT *, min(pos) OVER (PARTITION BY c_nationkey) AS g FROM h WHERE pos < size * 9) SELECT c_custkey, (row_number() OVER (ORDER BY g, pos) - 1) // size AS split FROM k""")
def splits(spark, sf_dir):
    return datasets.splits(table(spark, sf_dir, "customer"), "c_custkey", 9, "seed7", collate="c_nationkey")


@query("SELECT c_nationkey, row_number() OVER (ORDER BY min(c_custkey)) - 1 AS id FROM customer GROUP BY c_nationkey")
def dictionary_encode(spark, sf_dir):
    return datasets.encode(table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1")
def distinct_first(spark, sf_dir):
    return datasets.keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


@query("""WITH g AS (SELECT o_custkey, o_totalprice AS goal FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1) SELECT o_orderkey, o_custkey, goal FROM orders JOIN g USING (o_custkey)""")
def goal_rehydrate(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    goals = datasets.keep_first(o, ["o_custkey"], ["o_orderkey"]).select("o_custkey", F.col("o_totalprice").alias("goal"))
    return datasets.rehydrate(o.select("o_orderkey", "o_custkey"), goals, "o_custkey")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN c_custkey ELSE (SELECT min(s_suppkey) FROM supplier WHERE s_nationkey = c_nationkey) END AS resolved FROM customer""")
def name_resolution(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("nation", F.col("c_nationkey"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey")
    return datasets.resolve(c, "nation", F.when(F.col("c_custkey") % 5 == 0, F.col("c_custkey")), s, "s_suppkey", "s_suppkey").select("c_custkey", "resolved")


@query(FRAMES_SQL + """, p AS (SELECT episode_id, frame_index, count(*) OVER (PARTITION BY episode_id) AS n FROM frames)
SELECT episode_id, frame_index FROM p WHERE n <= 8 OR frame_index IN (SELECT round_even(i * (n - 1)::DOUBLE / 7, 0) FROM (SELECT unnest(range(8)) AS i))""")
def even_sample(spark, sf_dir):
    return datasets.even_sample(frames(spark, sf_dir).select("episode_id", "frame_index"), "frame_index", 8)


@query("SELECT o_custkey, coalesce(arg_max(o_orderkey, struct_pack(a := o_totalprice, b := -o_orderkey)) FILTER (o_orderstatus = 'F'), -1) AS largest FROM orders GROUP BY o_custkey")
def largest_allowed(spark, sf_dir):
    return datasets.largest(table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey", F.col("o_orderstatus") == "F")


@query("""WITH r AS (SELECT o_custkey, o_orderkey, sum(o_shippriority) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) / sum(o_shippriority) OVER (PARTITION BY o_custkey) AS share FROM (SELECT *, (1 + o_orderkey % 4)::DOUBLE AS o_shippriority FROM orders))
SELECT o_custkey, min(o_orderkey) AS chosen FROM r WHERE share >= (o_custkey % 10)::DOUBLE / 10 GROUP BY o_custkey""")
def weighted_choice(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("w", (1 + F.col("o_orderkey") % 4).cast("double"))
    return datasets.weighted_choice(o, ["o_custkey"], "w", "o_orderkey", (F.col("o_custkey") % 10).cast("double") / 10)


@query("SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey) - 1) // ((SELECT count(*) FROM part) // 5) AS scene FROM part")
def balanced_scenes(spark, sf_dir):
    """All parts as episodes, numbered by key; their number must divide evenly."""
    p = table(spark, sf_dir, "part").select("p_partkey")
    return running_before(p, ["p_partkey"], F.lit(1), "episode").select("p_partkey", datasets.balanced_scene(F.col("episode"), p.count(), 5).alias("scene"))


@query(FRAMES_SQL + "SELECT episode_id FROM episodes WHERE scene_id IN ('scene1', 'scene4')")
def scene_filter(spark, sf_dir):
    path = F.concat(F.lit("data/scene_datasets/"), F.col("scene_id"), F.lit(".basis.glb"))
    e = episodes(spark, sf_dir)
    return e.where(datasets.scene_allowed(path, ["scene1.basis", "scene4.basis"])).select("episode_id")


@query("SELECT p_partkey, (contains(p_name, 'a') OR contains(p_name, 'steel')) AND NOT contains(p_name, 'red') AS kept FROM part")
def substring_cull(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", datasets.has_substrings(F.col("p_name"), ["a", "steel"], ["red"]).alias("kept"))


@query("SELECT p_partkey, abs((p_size % 3) * 0.25) <= 0.5 AND p_retailprice / 60 BETWEEN 1 AND 30 AND NOT (p_retailprice / 60 / (p_size / 2.0::DOUBLE) < 1.1 AND (p_partkey % 100) / 100.0::DOUBLE > 20 * power(p_retailprice / 60 / (p_size / 2.0::DOUBLE) - 0.98, 2)) AND p_size % 5 >= 1.5 AS compatible FROM part")
def episode_compatibility(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    c = datasets.compatible((F.col("p_size") % 3) * 0.25, F.col("p_retailprice") / 60, F.col("p_size") / 2, F.col("p_size") % 5, (F.col("p_partkey") % 100) / 100.0)
    return p.select("p_partkey", c.alias("compatible"))


@query("""WITH need AS (SELECT o_custkey, unnest(['1-URGENT', '2-HIGH', '5-LOW']) AS kind FROM (SELECT DISTINCT o_custkey FROM orders))
SELECT o_custkey, count(*) AS n_missing, string_agg(kind, ',' ORDER BY kind) AS missing FROM need n WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = n.o_custkey AND o.o_orderpriority = kind) GROUP BY o_custkey""")
def missing_files(spark, sf_dir):
    """Required kinds that a group lacks, as with the files of an episode."""
    have = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("have"))
    gone = F.array_except(F.array(*map(F.lit, ["1-URGENT", "2-HIGH", "5-LOW"])), "have")
    return have.select("o_custkey", F.size(gone).cast("long").alias("n_missing"), F.array_join(gone, ",").alias("missing")).where("n_missing > 0")


# ---- text


@query(FRAMES_SQL + """, r AS (SELECT printf('%s/%06d/front', episode_id, frame_index) AS ref, concat('AT/train/', episode_id, '/f', printf('%06d', frame_index), '/sliding') AS context_key, episode_id, frame_index, 'front' AS camera FROM frames) SELECT * FROM r""")
def ref_roundtrip(spark, sf_dir):
    f = frames(spark, sf_dir)
    refs = f.select(text.ref(F.col("episode_id"), F.col("frame_index"), F.lit("front")).alias("ref"), text.context_key("AT", "train", F.col("episode_id"), F.col("frame_index"), "sliding").alias("context_key"))
    return refs.select("ref", "context_key", *text.parse_ref(F.col("ref")))


@query("""SELECT c_custkey, row_number() OVER (ORDER BY (CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END), CASE WHEN c_custkey % 3 > 0 THEN c_custkey END, CASE WHEN c_custkey % 3 = 0 THEN c_name END) AS place FROM customer""")
def natural_sort(spark, sf_dir):
    """All customers, numbered by a range partitioning and not by one window."""
    c = table(spark, sf_dir, "customer").withColumn("name", F.when(F.col("c_custkey") % 3 > 0, F.col("c_custkey").cast("string")).otherwise(F.col("c_name")))
    keyed = c.select("c_custkey", *(k.alias(f"k{i}") for i, k in enumerate(text.natural_key(F.col("name")))))
    return running_before(keyed, ["k0", "k1", "k2", "c_custkey"], F.lit(1), "before").select("c_custkey", (F.col("before") + 1).alias("place"))


WORDS_SQL = r"""WITH w AS (SELECT conv_id, turn, list_filter(list_transform(regexp_extract_all(replace(replace(lower(text), ',', ''), '?', ''), '[\p{L}\p{M}\p{N}\p{Pc}-]+|[^\p{L}\p{M}\p{N}\p{Pc}-]+'), lambda x: trim(x, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)))), lambda x: x <> '') AS ws FROM conversations),
each AS (SELECT conv_id, turn, i, ws[i] AS word FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM w))"""


@query(WORDS_SQL + " SELECT conv_id, turn, (i - 1)::INT AS i, word FROM each")
def tokenize(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(text.tokens(F.col("text"))).alias("i", "word"))


def _words(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("p"), text.tokens(F.col("text")).alias("words"))


VOCAB_SQL = WORDS_SQL + """, kept AS (SELECT word, min(struct_pack(p := conv_id * 1000 + turn, i := i)) AS f FROM each GROUP BY word HAVING count(*) >= 3),
vocab AS (SELECT word, row_number() OVER (ORDER BY f) + 3 AS id FROM kept UNION ALL SELECT unnest(['<pad>', '<s>', '</s>', '<unk>']), unnest([0, 1, 2, 3]))"""


@query(VOCAB_SQL + " SELECT word, id::BIGINT AS id FROM vocab")
def vocab(spark, sf_dir):
    return text.vocabulary(_words(spark, sf_dir), "words", "p", least=3)


@query(VOCAB_SQL + " SELECT conv_id * 1000 + turn AS p, (i - 1)::INT AS i, word, coalesce(id, 3)::BIGINT AS id FROM each LEFT JOIN vocab USING (word)")
def word_ids(spark, sf_dir):
    w = _words(spark, sf_dir)
    return text.word_ids(w, "words", "p", text.vocabulary(w, "words", "p", least=3))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Given' WHEN doc_id % 3 = 1 THEN lang ELSE 'Follow the main person.' END AS instruction, CASE WHEN doc_id % 3 = 1 THEN lang WHEN doc_id % 3 = 2 THEN '' ELSE 'Follow the main person.' END AS loose FROM documents")
def instruction_fallback(spark, sf_dir):
    given = F.when(F.col("doc_id") % 3 == 0, " Given ").otherwise("  ")
    stored = F.when(F.col("doc_id") % 3 == 1, F.col("lang")).when(F.col("doc_id") % 3 == 2, "  ")
    return table(spark, sf_dir, "documents").select("doc_id", text.instruction(given, stored).alias("instruction"), text.instruction_or_blank(stored).alias("loose"))


@query("SELECT event_id, json_extract_string(props, '$.k') <> '0' AS truth FROM events")
def truthiness(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.truthy(F.get_json_object("props", "$.k")).alias("truth"))


# ---- predicates

# nations are entities typed by their region; regions are types under one root
HIERARCHY = [("asia", "place"), ("europe", "place"), ("coast", "asia"), ("place", "thing")]


HIERARCHY_SQL = "WITH RECURSIVE p(sub, super) AS (SELECT DISTINCT p_type, p_brand FROM part UNION SELECT DISTINCT p_brand, concat('size', p_size) FROM part UNION SELECT DISTINCT concat('size', p_size), concat('class', p_size % 3) FROM part UNION SELECT DISTINCT concat('class', p_size % 3), 'thing' FROM part)"


@query(HIERARCHY_SQL + """, c AS (SELECT t AS sub, t AS super FROM (SELECT sub AS t FROM p UNION SELECT super FROM p) UNION SELECT c.sub, p.super FROM c JOIN p ON c.super = p.sub) SELECT sub, super FROM c""")
def type_closure(spark, sf_dir):
    """Types, brands, sizes and classes of parts under each other: thousands of paths lead from a type to the root."""
    p = table(spark, sf_dir, "part")
    size, group = F.concat(F.lit("size"), "p_size"), F.concat(F.lit("class"), F.col("p_size") % 3)
    steps = [(F.col("p_type"), F.col("p_brand")), (F.col("p_brand"), size), (size, group), (group, F.lit("thing"))]
    return logic.type_closure(reduce(DataFrame.unionByName, [p.select(a.alias("sub"), b.alias("super")).distinct() for a, b in steps]))


ENTITIES_SQL = """WITH e AS (SELECT n_name AS name, CASE n_regionkey WHEN 2 THEN 'asia' WHEN 3 THEN 'europe' WHEN 1 THEN 'coast' ELSE 'thing' END AS type, n_nationkey AS k FROM nation)"""


def _entities(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    kind = F.when(F.col("n_regionkey") == 2, "asia").when(F.col("n_regionkey") == 3, "europe").when(F.col("n_regionkey") == 1, "coast").otherwise("thing")
    return n.select(F.col("n_name").alias("name"), kind.alias("type"), F.col("n_nationkey").alias("k"))


@query(ENTITIES_SQL + "SELECT a.name AS e0, b.name AS e1 FROM e a, e b WHERE a.type IN ('asia', 'coast') AND b.type IN ('asia', 'europe', 'coast') AND a.name <> b.name")
def predicate_grounding(spark, sf_dir):
    closure = logic.type_closure(spark.createDataFrame(HIERARCHY, "sub string, super string"))
    return logic.assignments(_entities(spark, sf_dir).select("name", "type"), closure, ["asia", "place"])


@query(ENTITIES_SQL + "SELECT a.name AS e0, b.name AS e1 FROM e a, e b WHERE a.type IN ('asia', 'europe', 'coast') AND b.type IN ('asia', 'europe', 'coast') AND a.name < b.name")
def predicate_combinations(spark, sf_dir):
    closure = logic.type_closure(spark.createDataFrame(HIERARCHY, "sub string, super string"))
    return logic.assignments(_entities(spark, sf_dir).select("name", "type"), closure, ["place", "place"], ordered=False)


PLACES_SQL = """WITH lives AS (SELECT c_custkey AS c, c_nationkey AS n FROM customer), poor AS (SELECT c_custkey AS c FROM customer WHERE c_acctbal < -800), urgent AS (SELECT o_custkey AS c, o_orderkey AS o FROM orders WHERE o_orderpriority = '1-URGENT'),
served AS (SELECT c FROM urgent UNION SELECT c_custkey FROM customer WHERE c_acctbal >= 9900)"""


def _places(spark: SparkSession, sf_dir: str) -> quantifiers_.Domain:
    """Nations under their regions, customers and orders, and who lives where, is poor or rich, has placed what."""
    c, o, n = (table(spark, sf_dir, x) for x in ("customer", "orders", "nation"))
    person, order = F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("o"), "o_orderkey")
    nation = lambda k: F.concat(F.lit("n"), k)
    entities = c.select(person.alias("name"), F.lit("person").alias("type")).unionByName(o.select(order.alias("name"), F.lit("order").alias("type"))).unionByName(n.select(nation("n_nationkey").alias("name"), F.concat(F.lit("region"), "n_regionkey").alias("type")))
    parents = n.select(F.concat(F.lit("region"), "n_regionkey").alias("sub"), F.lit("place").alias("super")).distinct()
    facts = {
        "lives": c.select(person, nation("c_nationkey")), "poor": c.where("c_acctbal < -800").select(person), "rich": c.where("c_acctbal >= 9900").select(person),
        "placed": o.select(F.concat(F.lit("c"), "o_custkey"), order), "urgent": o.where("o_orderpriority = '1-URGENT'").select(order),
    }
    return quantifiers_.Domain(entities, parents, facts)


@query(PLACES_SQL + """ SELECT concat('n', n) AS place, concat('c', c) AS person FROM lives WHERE c IN (SELECT c FROM poor)
  AND n NOT IN (SELECT n FROM lives JOIN poor USING (c) WHERE c NOT IN (SELECT c FROM served))""")
def nested_quantifiers(spark, sf_dir):
    """Places and their poor, where all poor people of the place have an urgent order or are rich: for all, and exists in it, inside exists."""
    Is, All, Any, Quantified = quantifiers_.Is, *(lambda *parts, op=op: quantifiers_.Combined(op, parts) for op in ("and", "or")), quantifiers_.Quantified
    has_urgent = Quantified("exists", (("o", "order"),), All(Is("placed", ("q", "o")), Is("urgent", ("o",))))
    poor_here = quantifiers_.Combined("nand", (Is("lives", ("q", "place")), Is("poor", ("q",))))
    everyone = Quantified("forall", (("q", "person"),), Any(poor_here, has_urgent, Is("rich", ("q",))))
    whole = Quantified("exists", (("place", "place"), ("person", "person")), All(Is("lives", ("person", "place")), Is("poor", ("person",)), everyone))
    return _places(spark, sf_dir).bindings(whole)


@query(PLACES_SQL + """ SELECT concat('n', n_nationkey) AS place FROM nation WHERE n_regionkey IN (1, 2) AND n_nationkey NOT IN (SELECT n FROM lives JOIN poor USING (c)) OR n_regionkey IN (1, 2) AND n_nationkey IN (SELECT n FROM lives GROUP BY n HAVING bool_and(c IN (SELECT c FROM urgent)))""")
def negated_quantifiers(spark, sf_dir):
    """Places of two regions where nobody is poor, or everybody has an urgent order."""
    Is, Quantified, Combined = quantifiers_.Is, quantifiers_.Quantified, quantifiers_.Combined
    nobody = Quantified("forall", (("q", "person"),), Combined("nor", (Combined("and", (Is("lives", ("q", "place")), Is("poor", ("q",)))),)))
    urgent = Quantified("exists", (("o", "order"),), Combined("and", (Is("placed", ("q", "o")), Is("urgent", ("o",)))))
    busy = Combined("and", (Quantified("exists", (("r", "person"),), Is("lives", ("r", "place"))), Combined("nor", (Quantified("exists", (("q", "person"),), Combined("and", (Is("lives", ("q", "place")), Combined("nor", (urgent,))))),))))
    domain = _places(spark, sf_dir)
    found = [domain.satisfying(Combined("or", (nobody, busy)), {"place": kind}) for kind in ("region1", "region2")]
    return found[0].unionByName(found[1])


@query(FRAMES_SQL + "SELECT episode_id, bool_and(dis_to_human <= 5 AND vy >= -1) AS always, bool_or(human_collision) AS ever FROM frames GROUP BY episode_id")
def quantifiers(spark, sf_dir):
    f = frames(spark, sf_dir)
    always = logic.quantified(f, ["episode_id"], (F.col("dis_to_human") <= 5) & (F.col("vy") >= -1), forall=True).withColumnRenamed("holds", "always")
    ever = logic.quantified(f, ["episode_id"], F.col("human_collision"), forall=False).withColumnRenamed("holds", "ever")
    return always.join(ever, "episode_id")


@query(FRAMES_SQL + "SELECT episode_id, frame_index, NOT (human_following AND dis_to_human > 2) OR (human_collision AND vx > 0.1) AS holds, NOT (human_following OR human_collision) AS neither FROM frames")
def formula_eval(spark, sf_dir):
    f = frames(spark, sf_dir).withColumns({"far": F.col("dis_to_human") > 2, "fast": F.col("vx") > 0.1})
    holds = logic.formula(("or", ("nand", "human_following", "far"), ("and", "human_collision", "fast")))
    return f.select("episode_id", "frame_index", holds.alias("holds"), logic.formula(("nor", "human_following", "human_collision")).alias("neither"))


@query(FRAMES_SQL + "SELECT episode_id, total_step, status FROM episodes WHERE total_step % 2 = 0 AND status <> 'Lost'")
def filtered_episodes(spark, sf_dir):
    """Episodes that a predicate keeps."""
    return episodes(spark, sf_dir).where((F.col("total_step") % 2 == 0) & (F.col("status") != "Lost")).select("episode_id", "total_step", "status")


@query(FRAMES_SQL + "SELECT episode_id, frame_index, row_number() OVER (ORDER BY front_dhash, idx) - 1 AS place FROM frames")
def sorted_references(spark, sf_dir):
    """References in the order of a key that repeats, and of their number where it does."""
    f = frames(spark, sf_dir, with_index=True).select("episode_id", "frame_index", "front_dhash", "idx")
    return running_before(f, ["front_dhash", "idx"], F.lit(1), "place").select("episode_id", "frame_index", "place")


@query("SELECT count(DISTINCT c_nationkey) AS n_scenes, min(c_nationkey) AS first, max(c_nationkey) AS last FROM customer")
def scene_ids(spark, sf_dir):
    scenes = table(spark, sf_dir, "customer").select("c_nationkey").distinct()
    return scenes.agg(F.count("*").alias("n_scenes"), F.min("c_nationkey").alias("first"), F.max("c_nationkey").alias("last"))


@query("""WITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_nationkey % 4 <> 1), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_nationkey % 5 <> 2)
SELECT k, 'only_customer' AS side FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'only_supplier' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def key_differences(spark, sf_dir):
    """Keys that only one of two sets has; each lacks some."""
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).where("k % 4 <> 1").distinct()
    b = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")).where("k % 5 <> 2").distinct()
    return a.exceptAll(b).withColumn("side", F.lit("only_customer")).unionByName(b.exceptAll(a).withColumn("side", F.lit("only_supplier")))


@query("""WITH w AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL)
SELECT * FROM w WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def hourly_counts(spark, sf_dir):
    """The windows that a stream over the events has closed by its watermark, as its sink holds them."""
    from pathloom.streaming.episodes import collected, windowed_counts

    windows = collected(spark, f"{sf_dir}/events.parquet", lambda e: windowed_counts(e.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", "10 minutes", ["event_type"]))
    return windows.select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "n", F.round("total", 4).alias("total"))


@query("""WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) // 1000 AS ms, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
walk AS (
  SELECT user_id, i, ms AS start, ms AS last, 1 AS n, 0 AS number, NULL::BIGINT AS c_start, NULL::BIGINT AS c_end, NULL::INT AS c_n, NULL::VARCHAR AS cause, NULL::INT AS c_number FROM e WHERE i = 1
  UNION ALL
  SELECT user_id, i, CASE WHEN fresh THEN ms ELSE start END, ms, CASE WHEN fresh THEN 1 ELSE n + 1 END, number + (fresh AND n > 0)::INT,
    start, CASE WHEN late THEN deadline END, n, CASE WHEN late THEN why END, number
  FROM (SELECT *, n > 0 AND ms >= deadline AS late, n = 0 OR ms >= deadline AS fresh FROM (
    SELECT e.user_id, e.i, e.ms, w.start, w.last, CASE WHEN w.n = 15 THEN 0 ELSE w.n END AS n, w.number + (w.n = 15)::INT AS number,
      least(w.start + 345600000, w.last + 129600000) AS deadline, CASE WHEN w.start + 345600000 <= w.last + 129600000 THEN 'seconds' ELSE 'silent' END AS why
    FROM walk w JOIN e ON e.user_id = w.user_id AND e.i = w.i + 1))),
mark AS (SELECT max(epoch_us(ts) // 1000) - 600000 AS mark_ms FROM events),
tails AS (SELECT user_id, number, start, least(start + 345600000, last + 129600000) AS deadline, n, CASE WHEN start + 345600000 <= last + 129600000 THEN 'seconds' ELSE 'silent' END AS why FROM walk WHERE n < 15 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY i DESC) = 1 AND (SELECT max(i) FROM e WHERE e.user_id = walk.user_id) = walk.i)
SELECT user_id, c_number::BIGINT AS number, c_start AS start_ms, c_end AS end_ms, c_n::BIGINT AS n_steps, cause FROM walk WHERE cause IS NOT NULL
UNION ALL SELECT user_id, number, start, last, n, 'steps' FROM walk WHERE n = 15
UNION ALL SELECT user_id, number, start, deadline, n, why FROM tails, mark WHERE deadline <= mark_ms""")
def limited_episodes(spark, sf_dir):
    """Episodes closed by 15 steps, four days, or a day and a half of silence, from a stream in four runs, each from the state of the last."""
    from pathloom.streaming import episodes as streams

    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    low, high = e.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    part = F.least(F.floor((F.unix_micros("ts") - low) * 4 / max(high - low, 1)), F.lit(3))
    slices = [e.where(part == i) for i in range(4)]
    return streams.streamed_in_runs(spark, slices, lambda steps: streams.limited_episodes(steps, "user_id", "ts", "10 minutes", 15, 4 * 86400, 1.5 * 86400))


@query("""WITH h AS (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY md5('visit/' || c_custkey), c_custkey) - 1 AS place FROM customer)
SELECT c_custkey, c_nationkey, place, place // 3 AS turn FROM h""")
def iteration_order(spark, sf_dir):
    return datasets.iteration_order(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_custkey", "c_nationkey", "visit", 3)


@query("""WITH h AS (SELECT n_name, i AS number, md5('g/' || n_name || '/' || i) AS h FROM nation, (SELECT unnest(range(20)) AS i))
SELECT n_name, number, """ + ", ".join(f"round(('0x' || substr(h, {8 * i + 1}, 8))::BIGINT::DOUBLE / 4294967296 * 10, 6) AS {x}" for i, x in enumerate(("start_x", "start_z", "goal_x", "goal_z"))) + " FROM h")
def generated_episodes(spark, sf_dir):
    made = datasets.generated_episodes(table(spark, sf_dir, "nation"), "n_name", 20, "g")
    return made.select("n_name", "number", *(F.round(c, R).alias(c) for c in made.columns[2:]))


def _drawn(h: str, i: int) -> str:
    return f"(('0x' || substr({h}, {8 * i + 1}, 8))::BIGINT::DOUBLE / 4294967296)"


@query(f"""WITH scenes AS (SELECT n_name AS scene, 12.0::DOUBLE + n_nationkey AS side, 1 + n_nationkey % 3 AS floors FROM nation),
goals AS (SELECT *, {_drawn("h", 0)} * side AS gx, {_drawn("h", 1)} * side AS gz, floor({_drawn("h", 2)} * floors) AS gf, {_drawn("h", 3)} * 10 AS island FROM (SELECT *, md5('r/' || scene || '/' || target || '/goal') AS h FROM scenes, (SELECT unnest(range(120)) AS target))),
tries AS (SELECT *, {_drawn("h", 0)} * side AS sx, {_drawn("h", 1)} * side AS sz, floor({_drawn("h", 2)} * floors) AS sf, {_drawn("h", 3)} AS u FROM (SELECT scene, target, side, floors, gx, gz, gf, attempt, md5('r/' || scene || '/' || target || '/' || attempt) AS h FROM goals, (SELECT unnest(range(1, 5)) AS attempt) WHERE island >= 1.5)),
measured AS (SELECT *, abs(sx - gx) + abs(sz - gz) AS walked, (abs(sx - gx) + abs(sz - gz)) / sqrt((sx - gx) * (sx - gx) + (sz - gz) * (sz - gz)) AS ratio FROM tries),
fitting AS (SELECT *, sf = gf AND walked BETWEEN 9 AND 20 AND NOT (ratio < 1.1 AND u > 20 * (ratio - 0.98) * (ratio - 0.98)) AS ok FROM measured),
per AS (SELECT scene, target, min(attempt) FILTER (ok) AS hit, coalesce(min(attempt) FILTER (ok), 4) AS used FROM fitting GROUP BY ALL),
told AS (SELECT *, count(hit) OVER w AS taken, sum(used) OVER w AS drawn FROM per WINDOW w AS (PARTITION BY scene ORDER BY target))
SELECT told.scene, taken - 1 AS number, told.target, hit AS attempts, drawn::BIGINT AS drawn, round(sx, 6) AS start_x, round(sz, 6) AS start_z, round(gx, 6) AS goal_x, round(gz, 6) AS goal_z, round(walked, 6) AS distance
FROM told JOIN fitting f ON f.scene = told.scene AND f.target = told.target AND f.attempt = told.hit WHERE taken <= 30""")
def sampled_episodes(spark, sf_dir):
    """Up to 30 episodes a scene, each the first start that fits a goal, of four at most, for 120 goals at most."""
    n = table(spark, sf_dir, "nation")
    scenes = n.select(F.col("n_name").alias("scene"), (F.col("n_nationkey") + 12.0).alias("side"), (1 + F.col("n_nationkey") % 3).alias("floors"))
    made = sampling.sampled_episodes(scenes, 30, "r", near=9.0, far=20.0, retries=4, most_targets=120)
    return made.select(*made.columns[:5], *(F.round(c, R).alias(c) for c in made.columns[5:]))


def _scene_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as episodes whose line items are objects, with holders, states and markers that share their names."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("l"))
    case = lambda x: F.concat(F.lit("case"), x["l_suppkey"] % 7)
    thing = lambda x: F.concat(F.lit("part"), x["l_partkey"] % 50)
    pairs = F.transform("l", lambda x, i: F.struct(F.concat(thing(x), F.lit("_"), i), case(x)))
    states = F.transform("l", lambda x, i: F.struct(F.concat(case(x), F.lit("_"), i), F.map_from_arrays(F.array(i), F.array(x["l_quantity"]))))
    marker = F.struct(F.lit("cab").alias("name"), case(F.col("l")[0]).alias("type"), F.array(F.col("l")[0]["l_tax"]).alias("offset"), F.concat(F.lit("link"), F.size("l")).alias("link"), thing(F.col("l")[0]).alias("object"))
    return lines.select(
        F.col("l_orderkey").alias("episode"), F.transform("l", lambda x: F.struct(thing(x).alias("name"), F.array(x["l_quantity"], x["l_extendedprice"], x["l_discount"], x["l_tax"]).alias("transform"))).alias("objects"),
        F.map_from_entries(pairs).alias("holders"), F.map_from_entries(F.filter(states, lambda x: F.get(F.map_keys(x[F.lit("col2")]), 0) % 2 == 0)).alias("states"), F.when(F.col("l_orderkey") % 3 == 0, F.array(marker)).otherwise(F.array().cast("array<struct<name:string,type:string,offset:array<double>,link:string,object:string>>")).alias("markers"),
    )


POOL_SQL = """WITH l AS (SELECT l_orderkey AS o, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) - 1 AS i, count(*) OVER (PARTITION BY l_orderkey) AS n,
  concat('part', l_partkey % 50) AS thing, concat('case', l_suppkey % 7) AS holder, l_quantity AS q, l_extendedprice AS p, l_discount AS d, l_tax AS t FROM lineitem),
slots AS (SELECT o, i AS slot, thing AS name FROM l UNION ALL SELECT o, n + 2 * i, concat(thing, '_', i) FROM l UNION ALL SELECT o, n + 2 * i + 1, holder FROM l UNION ALL SELECT o, 3 * n + i // 2, concat(holder, '_', i) FROM l WHERE i % 2 = 0
  UNION ALL SELECT o, 3 * n + (n + 1) // 2 + j, CASE j WHEN 0 THEN 'cab' WHEN 1 THEN holder WHEN 2 THEN concat('link', n) ELSE thing END FROM l, (SELECT unnest(range(4)) AS j) WHERE i = 0 AND o % 3 = 0),
names AS (SELECT name, row_number() OVER (ORDER BY o, slot) - 1 AS id FROM (SELECT name, o, slot FROM slots QUALIFY row_number() OVER (PARTITION BY name ORDER BY o, slot) = 1))"""


@query(POOL_SQL + """, starts AS (SELECT o, sum(n) OVER (ORDER BY o) - n AS start FROM (SELECT DISTINCT o, n FROM l)),
x AS (SELECT o, slot, id FROM slots JOIN names USING (name))
SELECT o AS episode, string_agg(id, ',' ORDER BY slot) AS ids, any_value(start)::BIGINT AS first_at, any_value(n)::INT AS n_objects FROM x JOIN starts USING (o) JOIN (SELECT DISTINCT o, n FROM l) USING (o) GROUP BY o""")
def encoded_episodes(spark, sf_dir):
    """The numbers of an episode's names, in the order they are used, and its places in the pool of matrices."""
    e = pool.encode(_scene_objects(spark, sf_dir), "episode").episodes
    numbers = F.concat(F.transform("objects", lambda x: x["name"]), F.flatten(F.transform("holders", lambda x: F.array(x["key"], x["value"]))), F.map_keys("states"), F.flatten(F.transform("markers", lambda x: F.array(x["name"], x["type"], x["link"], x["object"]))))
    return e.select("episode", F.array_join(numbers.cast("array<string>"), ",").alias("ids"), F.col("objects")[0]["at"].alias("first_at"), F.size("objects").alias("n_objects"))


@query(POOL_SQL + """ SELECT o AS episode, string_agg(concat(thing, ':', (q * 100)::BIGINT, ':', round(p * 100)::BIGINT, ':', round(d * 100)::BIGINT), ',' ORDER BY i) AS objects, string_agg(concat(thing, '_', i, '>', holder), ',' ORDER BY i) AS holders,
  string_agg(CASE WHEN i % 2 = 0 THEN concat(holder, '_', i, '=', (q * 100)::BIGINT) END, ',' ORDER BY i) AS states, coalesce(max(CASE WHEN i = 0 AND o % 3 = 0 THEN concat('cab/', holder, '/link', n, '/', thing, '/', round(t * 100)::BIGINT) END), '') AS markers FROM l GROUP BY o""")
def decoded_episodes(spark, sf_dir):
    """Episodes that were encoded and decoded, as they were."""
    back = pool.decode(pool.encode(_scene_objects(spark, sf_dir), "episode"), "episode")
    cents = lambda x: F.round(x * 100).cast("long")
    told = lambda parts, f: F.array_join(F.transform(parts, f), ",")
    return back.select(
        "episode", told("objects", lambda x: F.concat_ws(":", x["name"], *(cents(x["transform"][i]) for i in range(3)))).alias("objects"), told(F.map_entries("holders"), lambda x: F.concat(x["key"], F.lit(">"), x["value"])).alias("holders"),
        told(F.map_entries("states"), lambda x: F.concat(x["key"], F.lit("="), cents(F.map_values(x["value"])[0]))).alias("states"), told("markers", lambda x: F.concat_ws("/", x["name"], x["type"], x["link"], x["object"], cents(x["offset"][0]))).alias("markers"),
    )


@query(FRAMES_SQL + """, x AS (SELECT episode_id, frame_index, CASE WHEN human_following THEN -2.0 WHEN dis_to_human > 3 THEN dis_to_human / 2 ELSE 1.0 END AS step FROM frames),
w AS (SELECT episode_id, frame_index, least(10, greatest(0, 3 + step))::DOUBLE AS meter FROM x WHERE frame_index = 0
  UNION ALL SELECT x.episode_id, x.frame_index, least(10, greatest(0, w.meter + x.step))::DOUBLE FROM w JOIN x ON x.episode_id = w.episode_id AND x.frame_index = w.frame_index + 1)
SELECT episode_id, round(arg_max(meter, frame_index), 6) AS patience FROM w GROUP BY episode_id""")
def patience(spark, sf_dir):
    """A meter that rises while the person is away and falls while the robot follows, between 0 and 10: no window says it, and its pieces merge."""
    step = lambda r: -2.0 if r["human_following"] else r["dis_to_human"] / 2 if r["dis_to_human"] > 3 else 1.0
    found = folds.measured(frames(spark, sf_dir), ["episode_id"], ["frame_index"], ["human_following", "dis_to_human"], folds.Patience(step, 0.0, 10.0, 3.0), "patience")
    return found.select("episode_id", F.round("patience", R).alias("patience"))


@query("SELECT doc_id, concat(CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN 'who ' ELSE 'is ' END, CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'who ' END, 'there ?') AS sentence FROM documents")
def word_sentence(spark, sf_dir):
    known = F.array(*map(F.lit, ("<pad>", "who", "is", "there")))
    ids = F.array(F.col("doc_id") % 3, F.col("doc_id") % 2, F.lit(3).cast("long"))
    return table(spark, sf_dir, "documents").select("doc_id", text.sentence(ids, known).alias("sentence"))


@query("""WITH r AS (SELECT p_partkey, p_name, CASE WHEN p_size % 7 > 0 THEN p_brand END AS parent, p_size % 11 - 5.0 AS ux, 10.0 AS uy FROM part)
SELECT p_partkey, CASE WHEN contains(p_name, 'bolt') OR coalesce(contains(parent, '#2'), false) THEN false WHEN parent IS NULL THEN contains(p_name, 'red')
  WHEN contains(p_name, 'red') AND contains(parent, '#1') THEN true WHEN contains(p_name, 'hot') THEN false ELSE contains(p_name, 'blue') END AS matches, uy / sqrt(ux * ux + uy * uy) >= 0.95 AS upright FROM r""")
def receptacle_match(spark, sf_dir):
    sets = [datasets.ReceptacleSet(objects=("#1",), names=("red",), not_objects=("#2",), not_names=("bolt",)), datasets.ReceptacleSet(names=("blue",), not_names=("hot",))]
    parent = F.when(F.col("p_size") % 7 > 0, F.col("p_brand"))
    up = datasets.upright(F.col("p_size") % 11 - 5.0, F.lit(10.0), F.lit(0.0), 0.95)
    return table(spark, sf_dir, "part").select("p_partkey", datasets.receptacle_matches(F.col("p_name"), parent, sets).alias("matches"), up.alias("upright"))


@query("""WITH RECURSIVE o AS (SELECT c, c_custkey AS k, c_nationkey AS s, 1 + c_custkey % 7 AS n, md5('v/' || c || '/' || c_custkey) AS h FROM customer, (SELECT unnest([0, 1]) AS c)),
p AS (SELECT *, row_number() OVER (PARTITION BY c, s ORDER BY h, k) - 1 AS place FROM o),
draw AS (SELECT c, s, t, 8 + floor(('0x' || substr(md5('v/' || c || '/' || s || '/' || t), 1, 8))::BIGINT::DOUBLE / 4294967296 * 5)::BIGINT AS lim FROM (SELECT DISTINCT c, s FROM o), (SELECT unnest(range(0, 2000)) AS t)),
walk AS (SELECT c, s, k, place, 0::BIGINT AS turn, n AS steps FROM p WHERE place = 0
  UNION ALL SELECT p.c, p.s, p.k, p.place, w.turn + (w.steps >= d.lim)::INT, CASE WHEN w.steps >= d.lim THEN 0 ELSE w.steps END + p.n FROM walk w JOIN p ON p.c = w.c AND p.s = w.s AND p.place = w.place + 1 JOIN draw d ON d.c = w.c AND d.s = w.s AND d.t = w.turn),
scenes AS (SELECT c, s, row_number() OVER (PARTITION BY c ORDER BY min(h), s) - 1 AS scene_place FROM o GROUP BY c, s)
SELECT walk.c AS cycle, walk.s AS c_nationkey, k AS c_custkey, turn, scene_place, place FROM walk JOIN scenes ON scenes.c = walk.c AND scenes.s = walk.s""")
def visit_turns(spark, sf_dir):
    """Two shuffled cycles of visits that leave a scene after 8 to 12 steps, as drawn for each turn."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", (1 + F.col("c_custkey") % 7).alias("n"))
    return datasets.visit_turns(c, "c_custkey", "c_nationkey", "n", 10, 0.2, "v", cycles=2)


@query(FRAMES_SQL + """, t AS (SELECT episode_id, frame_index, human_following AS a, dis_to_human > 2 AS b, human_collision AS c FROM frames)
SELECT episode_id, frame_index, a AS and_0, CASE WHEN a THEN b END AS and_1, CASE WHEN a AND b THEN c END AS and_2, a AS or_0, CASE WHEN NOT a THEN b END AS or_1, CASE WHEN NOT a AND NOT b THEN c END AS or_2 FROM t""")
def formula_trace(spark, sf_dir):
    """Which parts of a conjunction and of a negated disjunction are looked at, and what they are."""
    f = frames(spark, sf_dir).withColumn("far", F.col("dis_to_human") > 2)
    traces = {op: logic.truth_trace((name, "human_following", "far", "human_collision")) for op, name in (("and", "and"), ("or", "nor"))}
    return f.select("episode_id", "frame_index", *(t[i].alias(f"{op}_{i}") for op, t in traces.items() for i in range(3)))


@query(FRAMES_SQL + """, t AS (SELECT episode_id, frame_index, human_following AS a, dis_to_human > 2 AS b, human_collision AS c, vx > 0.5 AS d FROM frames),
v AS (SELECT *, NOT (b AND c) AS n, (a OR d) AS o FROM t), w AS (SELECT *, NOT (n OR d) AS r, o AND n AND NOT (n OR d) AS root FROM v)
SELECT episode_id, frame_index, unnest(range(0, 10))::INT AS node, unnest([root, o, a, CASE WHEN NOT a THEN d END, CASE WHEN o THEN r END, CASE WHEN o THEN n END, CASE WHEN o THEN b END, CASE WHEN o AND b THEN c END, CASE WHEN o AND NOT n THEN d END, CASE WHEN o AND r THEN b END]) AS value
FROM (SELECT * REPLACE (o AND r AND b AS root) FROM w)""")
def nested_trace(spark, sf_dir):
    """All nodes of a formula of three levels, in pre-order, each where it was asked for."""
    f = frames(spark, sf_dir).withColumns({"b": F.col("dis_to_human") > 2, "d": F.col("vx") > 0.5})
    tree = ("and", ("or", "human_following", "d"), ("nor", ("nand", "b", "human_collision"), "d"), "b")
    return f.select("episode_id", "frame_index", F.explode(logic.nested_trace(tree)).alias("t")).select("episode_id", "frame_index", "t.node", "t.value")


@query("""SELECT o_orderkey, strftime(o_orderdate::TIMESTAMP + INTERVAL 1 SECOND * (o_orderkey % 86400), '%Y%m%dT%H%M%SZ') AS stamp, epoch(o_orderdate::TIMESTAMP)::BIGINT + o_orderkey % 86400 AS seconds,
  strftime(o_orderdate::TIMESTAMP + INTERVAL 1 SECOND * (o_orderkey % 86400), '%Y-%m-%dT%H:%M:%S+00:00') AS iso FROM orders""")
def time_stamps(spark, sf_dir):
    """Stamps of backups and events: written, read back, and as seconds."""
    at = F.timestamp_seconds(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400)
    stamped = table(spark, sf_dir, "orders").select("o_orderkey", text.stamp(at).alias("stamp"), text.iso_time(at).alias("iso"))
    return stamped.select("o_orderkey", "stamp", F.unix_timestamp(text.parse_stamp(F.col("stamp"))).alias("seconds"), "iso")


@query("SELECT vec_id, CASE WHEN vec_id % 5 = 0 OR vec_id % 5 = 1 THEN -1.0::DOUBLE ELSE round(embedding[1]::DOUBLE, 6) + 0.0 END AS scalar FROM embeddings")
def measure_scalar(spark, sf_dir):
    """The first element of a measure as a number; absent, empty and not-a-number ones give the default."""
    values = F.when(F.col("vec_id") % 5 == 0, F.array().cast("array<double>")).when(F.col("vec_id") % 5 == 1, F.array(F.lit(float("nan")))).when(F.col("vec_id") % 5 != 5, F.col("embedding").cast("array<double>"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(text.first_number(values, -1.0), 6).alias("scalar"))


@query("SELECT p_partkey, concat('on_', p_size) AS name, 2::INT AS n_args, p_brand AS first_arg, concat('c', p_size) AS last_arg FROM part")
def name_parser(spark, sf_dir):
    """Predicates written as name(arg, arg), with spaces, taken apart."""
    written = F.concat(F.lit("  on_"), "p_size", F.lit("( "), "p_brand", F.lit(" ,  c"), "p_size", F.lit(", ) "))
    name, args = text.call_parts(written)
    return table(spark, sf_dir, "part").select("p_partkey", name, args).select("p_partkey", "name", F.size("args").alias("n_args"), F.col("args")[0].alias("first_arg"), F.col("args")[1].alias("last_arg"))


@query("SELECT c_custkey, row_number() OVER (ORDER BY lower(regexp_extract(c_name, '^[^0-9]*')), regexp_extract(c_name, '[0-9]+')::BIGINT) AS place FROM (SELECT c_custkey, concat(CASE WHEN c_custkey % 2 = 0 THEN 'Room' ELSE 'room' END, c_custkey) AS c_name FROM customer)")
def natural_split_sort(spark, sf_dir):
    """Names with numbers in them, the numbers compared as such and letters without case."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.when(F.col("c_custkey") % 2 == 0, "Room").otherwise("room"), "c_custkey").alias("name"))
    return running_before(c.select("c_custkey", text.natural_split_key(F.col("name")).alias("key")), ["key", "c_custkey"], F.lit(1), "before").select("c_custkey", (F.col("before") + 1).alias("place"))
