"""Benchmark decontamination with a distributed positional inverted index. DataFrame operations only.

``build_index`` stores a posting (term, doc, pos) for every word of the corpus that some test item holds; no other word
can be asked for. A window is ``WINDOW`` consecutive words of an item, or all words of a shorter one. ``phrase_matches``
orders a window's terms by the number of their postings, all counted:

1. the postings of the rarest term, each less the term's offset in the window, are the candidate starts;
2. they are intersected with the offset-adjusted postings of the second rarest term;
3. what is left asks for the postings of all other terms at once, and a candidate stays if every one is there.

So frequent words are read once, against few candidates, and a window with a word that the corpus lacks is dropped before
any posting is read. Postings meet candidates by document and position, which no frequent word, passage or document can
concentrate in one task. ``proximity_matches`` gives the places where all terms of a window stand, in any order, within a
stretch of ``slack`` more words than the window has; ``contamination`` takes both from the same search.

The terms and windows of the benchmark are joined without a hint: Spark broadcasts them if their stored size is below its
threshold and shuffles otherwise. Null and empty texts have no words and match nothing; an item without words gives no
window; very long texts are indexed whole; documents are told apart by 64 bits of id and text, so rows with null or equal ids
are documents of their own, and equal rows get equal results; an empty corpus gives an empty table, an empty benchmark no
match. Other columns, whatever their names, stay untouched in ``drop_contaminated`` and are not read elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import LETTERED, fresh, lowered, row_key, stored

WINDOW = 10
SLACK = 5
#: Words of a cell in which places meet; a window and its slack reach into one neighbour at most.
CELL = 64
END = "\x00"


def words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(LETTERED), F.lit(0))


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """``item`` and ``window``, the array of words, for each window of each item."""
    tokens = items.select(F.col(f"`{item_col}`").alias("item"), words(F.col(f"`{text_col}`")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    return (tokens.select("item", "words", F.explode(starts).alias("start"))
            .select("item", F.slice("words", F.col("start"), F.lit(window)).alias("window")).distinct())


def build_index(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Postings ``term``, ``doc``, ``pos`` of the given terms (columns ``word`` and ``term``), stored. Behind its last word
    every text has the word END, no word of any text, so its place is the number of words."""
    named = docs.select(row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("doc"), F.col(f"`{text_col}`").alias("text"))
    ended = F.concat(F.coalesce(words(F.col("text")), F.array().cast("array<string>")), F.array(F.lit(END)))
    tokens = named.select("doc", F.posexplode(ended).alias("pos", "word"))
    return stored(tokens.join(terms, "word").select("term", "doc", "pos"), "postings")


class Index:
    """Postings of a corpus for the terms of a benchmark, and the windows with their terms from the rarest on.

    ``windows`` has ``id``, ``length`` and ``order``, an array of (n, offset, term) that is sorted by the number n of
    postings; only windows all of whose terms occur are in it. ``items`` has ``id`` and ``item``; ``lengths`` the number of
    words (``pos``) of each ``doc``.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int):
        all_windows = stored(item_windows(items, item_col, item_text_col, window), "windows")
        end = docs.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(-1).cast("long").alias("term"))
        terms = stored(all_windows.select(F.explode("window").alias("word")).distinct()
                       .withColumn("term", F.monotonically_increasing_id()).unionByName(end), "terms")
        everything = build_index(docs, terms, id_col, text_col)
        self.postings, self.lengths = everything.where("term >= 0"), everything.where("term < 0").select("doc", "pos").distinct()
        counts = self.postings.groupBy("term").agg(F.count("*").alias("n")).join(terms, "term")
        sequences = stored(all_windows.select("window").distinct().withColumn("id", F.monotonically_increasing_id()), "sequences")
        placed = sequences.select("id", F.size("window").alias("length"), F.posexplode("window").alias("offset", "word"))
        self.windows = stored(placed.join(counts, "word").groupBy("id", "length")
                              .agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("order"))
                              .where(F.size("order") == F.col("length")), "orders")
        self.items = stored(all_windows.join(sequences, "window").select("id", "item"), "window-items")

    def at(self, nth: int) -> DataFrame:
        """Windows with their nth rarest term: id, length, offset, term."""
        return (self.windows.where(F.col("length") > nth)
                .select("id", "length", F.col("order")[nth]["offset"].alias("offset"), F.col("order")[nth]["term"].alias("term")))


def meet(wanted: DataFrame, postings: DataFrame) -> DataFrame:
    """Rows of ``wanted`` (doc, pos, term) that are postings."""
    p = postings.select(F.col("term").alias("p_term"), F.col("doc").alias("p_doc"), F.col("pos").alias("p_pos"))
    return wanted.join(p, (F.col("doc") == F.col("p_doc")) & (F.col("pos") == F.col("p_pos"))
                       & (F.col("term") == F.col("p_term")), "left_semi")


def phrase_matches(index: Index) -> DataFrame:
    """``id``, ``length``, ``doc`` and ``start`` of every occurrence of every window."""
    start = F.col("pos") - F.col("offset")
    first = (index.postings.join(index.at(0), "term").withColumn("start", start).where("start >= 0")
             .select("id", "length", "doc", "start").distinct())
    # a single word is matched by its posting; others ask for their second rarest term
    second = index.at(1).select("id", "offset", "term")
    asked = first.where("length > 1").join(second, "id").withColumn("pos", F.col("start") + F.col("offset"))
    second_terms = index.at(1).select("term").distinct()
    two = stored(meet(asked, index.postings.join(second_terms, "term", "left_semi"))
                 .select("id", "length", "doc", "start"), "candidates")
    rest = index.windows.where("length > 2").select("id", F.explode(F.slice("order", 3, 1 << 20)).alias("t")).select(
        "id", "t.offset", "t.term")
    wanted = two.join(rest, "id").withColumn("pos", F.col("start") + F.col("offset"))
    others = (meet(wanted, index.postings).groupBy("id", "length", "doc", "start")
              .agg(F.count("*").alias("there")).where("there = length - 2").drop("there"))
    return first.where("length = 1").unionByName(two.where("length = 2")).unionByName(others)


def in_cells(wanted: DataFrame, place: str) -> DataFrame:
    """Adds ``cell``: the cell of a place, and the one beside it where ``width`` words reach over the border."""
    cell, within = F.floor(F.col(place) / CELL), F.col(place) % CELL
    reach = F.least(F.col("width"), F.lit(CELL))
    return wanted.withColumn("cell", F.explode(F.sequence(cell - F.when(within < reach, 1).otherwise(0),
                                                          cell + F.when(within >= CELL - reach, 1).otherwise(0))))


def near_places(index: Index, slack: int) -> DataFrame:
    """``id``, ``doc``, ``anchor`` (a place of the window's rarest term, ``rare``) and ``places``, all places of the window's terms
    less than ``width`` (its length and the slack) away, where each term has one.

    The second rarest term is asked for first, and only what it leaves for the others. Places meet in cells of CELL words.
    """
    terms = (index.windows.select("id", (F.col("length") + slack).alias("width"), F.explode("order").alias("t")).groupBy("id", "width", "t.term")
             .agg(F.min("t.n").alias("n")).groupBy("id", "width").agg(F.array_sort(F.collect_list(F.struct("n", "term"))).alias("order")))
    terms = stored(terms.select("id", "width", F.transform("order", lambda t: t["term"]).alias("terms")), "near-terms")
    p = index.postings.select(F.col("term").alias("p_term"), F.col("doc").alias("p_doc"), F.col("pos").alias("p_pos"),
                              F.floor(F.col("pos") / CELL).alias("p_cell"))
    close = ((F.col("doc") == F.col("p_doc")) & (F.col("cell") == F.col("p_cell")) & (F.col("term") == F.col("p_term"))
             & (F.abs(F.col("p_pos") - F.col("anchor")) < F.col("width")))
    rarest = terms.select("id", "width", F.col("terms")[0].alias("p_term"), F.get("terms", F.lit(1)).alias("term"))
    anchors = p.join(rarest, "p_term").select("id", F.col("p_doc").alias("doc"), F.col("p_pos").alias("anchor"), "width", "term")
    second = p.join(terms.where(F.size("terms") > 1).select(F.col("terms")[1].alias("p_term")).distinct(), "p_term", "left_semi")
    two = in_cells(anchors.where("term is not null"), "anchor").join(second, close, "left_semi").select("id", "doc", "anchor").distinct()
    left = stored(two.unionByName(anchors.where("term is null").select("id", "doc", "anchor")), "near-candidates")
    asked = left.join(terms.select("id", "width", F.size("terms").alias("many"), F.col("terms")[0].alias("rare"),
                                         F.explode("terms").alias("term")), "id")
    found = (in_cells(asked, "anchor").join(p, close).groupBy("id", "doc", "anchor", "width", "many", "rare")
             .agg(F.collect_set(F.struct(F.col("p_pos").alias("pos"), "term")).alias("places")))
    return found.where(F.size(F.array_distinct(F.transform("places", lambda p: p["term"]))) == F.col("many"))


def near_and_exact(index: Index, slack: int = SLACK) -> tuple[DataFrame, DataFrame]:
    """What ``proximity_matches`` and ``phrase_matches`` give, from one search: an occurrence is near as well, so the few
    places that are left are compared word by word, offset-adjusted."""
    found = stored(near_places(index, slack), "near-places")
    width = F.col("width")
    # a stretch begins at one of the places before the anchor
    whole = F.exists("places", lambda b: (b["pos"] <= F.col("anchor")) & (b["pos"] + width > F.col("anchor")) & (F.size(F.array_distinct(
        F.transform(F.filter("places", lambda p: (p["pos"] >= b["pos"]) & (p["pos"] < b["pos"] + width)), lambda p: p["term"]))) == F.col("many")))
    near = found.where(whole).select("id", "doc", F.col("anchor").alias("pos"))
    ordered = found.join(index.windows, "id")
    starts = F.transform(F.filter("order", lambda o: o["term"] == F.col("rare")), lambda o: F.col("anchor") - o["offset"])
    there = F.filter(starts, lambda s: (s >= 0) & F.forall("order", lambda o: F.exists(
        "places", lambda p: (p["pos"] == s + o["offset"]) & (p["term"] == o["term"]))))
    exact = ordered.select("id", "length", "doc", F.explode(there).alias("start")).distinct()
    return near, exact


def proximity_matches(index: Index, slack: int = SLACK) -> DataFrame:
    """``id``, ``doc`` and ``pos`` of a window's rarest term where all its distinct terms stand within length + slack words."""
    return near_and_exact(index, slack)[0]


def items_of(matches: DataFrame, index: Index, name: str) -> DataFrame:
    """Per ``doc`` the items of its matched windows, sorted as strings."""
    return (matches.select("doc", "id").distinct().join(index.items, "id")
            .select("doc", F.col("item").cast("string").alias("item")).distinct()
            .groupBy("doc").agg(F.array_sort(F.collect_list("item")).alias(name)))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """Per document: ``n_words``, ``n_hit`` words inside matched windows, ``items``, those of the matched windows, sorted
    as strings, ``contaminated``, and ``near_items``, those of windows whose words all stand near each other."""
    index = Index(docs, items, id_col, text_col, item_col, item_text_col, window)
    close, exact = near_and_exact(index, slack)
    matches = stored(exact, "matches")
    hit = (matches.select("doc", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("pos"))
           .distinct().groupBy("doc").agg(F.count("*").alias("n_hit")))
    near = items_of(close, index, "near_items")
    found = hit.join(items_of(matches, index, "items"), "doc").join(near, "doc", "full_outer").withColumnRenamed("doc", "hit_doc")
    ident, text, none = F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.array().cast("array<string>")
    counted = index.lengths.select("doc", F.col("pos").cast("long").alias("n_words")).join(
        found, F.col("doc") == F.col("hit_doc"), "left").withColumnRenamed("doc", "counted_doc")
    return (docs.select(ident.alias("id"), row_key(ident, text).alias("doc"))
            .join(counted, F.col("doc") == F.col("counted_doc"))
            .select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", none).alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
                    F.coalesce("near_items", none).alias("near_items")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents without any matched window, with all their columns."""
    name = fresh("leak", docs)
    index = Index(docs, items, id_col, text_col, item_col, item_text_col, window)
    leaks = stored(phrase_matches(index).select(F.col("doc").alias(name)).distinct(), "leaks")
    return docs.join(leaks, row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")) == F.col(name), "left_anti")


#: The same in DuckDB's SQL, windows compared as lists of words.
CONTAMINATION_SQL = r"""WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (SELECT DISTINCT item_id, array_to_string(words[start:start + 9], ' ') AS sequence, least(len(words), 10) AS length
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 8, 2))) AS start FROM items WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT length FROM windows),
places AS (SELECT doc_id, start, length, array_to_string(words[start:start + length - 1], ' ') AS sequence
    FROM (SELECT doc_id, words, length, unnest(range(1, len(words) - length + 2)) AS start FROM docs, lengths WHERE len(words) >= length)),
matches AS (SELECT doc_id, start, p.length, item_id FROM places p JOIN windows w ON p.sequence = w.sequence AND p.length = w.length),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(start, start + length)) AS place FROM matches) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM matches) GROUP BY 1),
asked AS (SELECT sequence, length, unnest(list_distinct(string_split(sequence, ' '))) AS word FROM (SELECT DISTINCT sequence, length FROM windows)),
sizes AS (SELECT sequence, count(*) AS terms FROM asked GROUP BY 1),
words AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM docs),
whole AS (SELECT doc_id, sequence FROM (SELECT DISTINCT doc_id, word FROM words) JOIN asked USING (word) JOIN sizes USING (sequence)
    GROUP BY doc_id, sequence, terms HAVING count(*) = terms),
found AS (SELECT doc_id, sequence, length, pos, word FROM whole JOIN asked USING (sequence) JOIN words USING (doc_id, word)),
close AS (SELECT DISTINCT doc_id, sequence FROM (SELECT a.doc_id, a.sequence, a.pos FROM found a JOIN found b ON a.doc_id = b.doc_id
    AND a.sequence = b.sequence AND b.pos >= a.pos AND b.pos < a.pos + a.length + 5 JOIN sizes s ON s.sequence = a.sequence
    GROUP BY a.doc_id, a.sequence, a.pos, s.terms HAVING count(DISTINCT b.word) = s.terms)),
near AS (SELECT doc_id, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS near_items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM close JOIN windows USING (sequence)) GROUP BY 1)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
    CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, sha256(coalesce(near_items, '')) AS near_sha256
FROM docs d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id LEFT JOIN near r ON d.doc_id = r.doc_id"""
