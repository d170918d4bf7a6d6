"""The same results in SQL over the same tables, where SQL can express them on whole tables."""

from __future__ import annotations

# Windows of 35 words as text; a word is gone if any window over it occurs twice.
_SUBSTRINGS = r"""
with texts as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (select r, unnest(range(1, len(w) - 33)) as p, w from texts where len(w) >= 35),
windows as (select r, p, array_to_string(w[p:p + 34], ' ') as k from starts),
again as (select k from windows group by k having count(*) > 1),
gone as (select distinct r, unnest(range(p, p + 35)) as i from windows semi join again using (k)),
words as (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from texts),
kept as (select r, string_agg(word, ' ' order by i) as t, count(*) as n from words anti join gone using (r, i) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from texts left join kept using (r)"""

# Equal words at equal distances; thirteen places in a row of which eleven agree, or a shorter item as it is.
_LEAKS = r"""
with docs as (select row_number() over () as r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN]+') as w from documents),
items as (select item_id, regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN]+') as w from benchmark),
d as (select r, unnest(w) as word, unnest(range(0, len(w))) as i, len(w) as n_doc from docs),
b as (select item_id, unnest(w) as word, unnest(range(0, len(w))) as j, len(w) as n_item from items where len(w) >= 5),
same as (select r, item_id, i - j as shift, j, n_item, n_doc from d join b using (word)),
able as (select * from same qualify count(*) over (partition by r, item_id, shift) >= least(11, n_item)),
places as (select r, item_id, shift, unnest(range(greatest(0, -shift), least(n_item, n_doc - shift))) as j, n_item
           from (select distinct r, item_id, shift, n_item, n_doc from able)),
flags as (select p.*, case when a.j is null then 0 else 1 end as hit from places p left join able a using (r, item_id, shift, j)),
sums as (select *, sum(hit) over ahead as hits, count(*) over ahead as size from flags
         window ahead as (partition by r, item_id, shift order by j rows between current row and 12 following)),
whole as (select *, sum(hit) over (partition by r, item_id, shift) as all_hits from sums),
good as (select r, item_id, shift, j, n_item from whole
         where n_item >= 13 and size = 13 and hits >= 11 or n_item < 13 and all_hits = n_item and j = 0),
runs as (select *, j - row_number() over (partition by r, item_id, shift order by j) as run from good),
long as (select r, item_id, max(n) as n from (select r, item_id, shift, run, count(*) - 1 + least(13, any_value(n_item)) as n from runs group by all) group by all),
found as (select r, list(distinct item_id order by item_id) as item_ids, max(n) as n_words from long group by r)
select doc_id, item_ids is not null as contaminated, coalesce(array_to_string(item_ids, ','), '') as item_ids, cast(coalesce(n_words, 0) as bigint) as n_words
from docs left join found using (r)"""

# The checksum bit by bit; then places whose next 16 words agree with those a distance later, which any run has.
_RUNS = r"""
with texts as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
sums as (select r, doc_id, w, cast(len(w) as bigint) as n, xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(cast(doc_id as varchar), ''),
         lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))), lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) as h from texts),
starts as (select *, case when n > 0 then (h // 10) % n end as a from sums),
periods as (select *, 1 + (n - a) // (3 + (h // 10) % 8) as p from starts),
planted as (select r, doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % p end]) else w end as w from periods),
places as (select r, n, w, unnest(range(0, n - 15)) as i from planted where n >= 24),
grams as (select r, n, i, array_to_string(w[i + 1:i + 16], ' ') as k from places),
pairs as (select x.r, x.i, y.i - x.i as q from grams x join grams y on x.r = y.r and x.k = y.k and y.i > x.i and 3 * (y.i - x.i) <= x.n),
groups as (select *, i - row_number() over (partition by r, q order by i) as g from pairs),
stretches as (select r, q, min(i) as s, count(*) + 15 + q as length from groups group by r, q, g),
runs as (select r, s, length, min(q) as q from stretches where length >= greatest(24, 3 * q) group by r, s, length),
lists as (select r, count(*) as n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' order by s, q) as lines from runs group by r),
top as (select * from runs qualify row_number() over (partition by r order by length / q desc, s, q) = 1),
words as (select r, unnest(w) as word, unnest(range(0, n)) as i from planted),
gone as (select distinct r, unnest(range(s + q, s + length)) as i from runs),
kept as (select r, string_agg(word, ' ' order by i) as t from words anti join gone using (r, i) group by r)
select doc_id, n as n_words, coalesce(n_runs, 0) as n_runs, s as start, length, q as period, (1000 * length) // q as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(t, '')) as collapsed_sha256
from planted left join lists using (r) left join top using (r) left join kept using (r)"""

_NEGATIVES = """
with vectors as (select row_number() over () as r, vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
                 list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings where vec_id is not null and label is not null and embedding is not null),
able as (select * from vectors where len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0),
scores as (select a.r as anchor, a.vec_id as anchor_id, a.label as anchor_label, b.r, b.vec_id, b.label, cast(coalesce(list_inner_product(a.v, b.v), 0) as bigint) as score
           from able a join able b on a.r <> b.r and a.vec_id % 100 = 0),
positives as (select * from scores where label = anchor_label qualify row_number() over (partition by anchor order by score desc, vec_id, r) <= 5),
negatives as (select p.anchor_id, p.vec_id as positive_id, p.score as positive_score, n.vec_id as negative_id, n.score as negative_score,
              cast(row_number() over (partition by p.anchor, p.r order by n.score desc, n.vec_id, n.r) as integer) as rank
              from positives p join scores n on p.anchor = n.anchor and n.label <> n.anchor_label and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 10"""

# Bytes as pairs of hex digits; places whose next 400 bytes occur twice, as stretches, and the bytes between these.
_BYTES = """
with texts as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as x from documents),
sizes as (select *, length(x) // 2 as n from texts),
starts as (select r, unnest(range(0, n - 399)) as p, x from sizes where n >= 400),
windows as (select r, p, md5(substr(x, 2 * p + 1, 800)) as k from starts),
again as (select k from windows group by k having count(*) > 1),
hits as (select r, p, lag(p) over (partition by r order by p) as before from windows semi join again using (k)),
marks as (select r, p, sum(case when before is null or p > before + 400 then 1 else 0 end) over (partition by r order by p) as span from hits),
spans as (select r, span, min(p) as low, max(p) + 400 as high from marks group by r, span),
gaps as (select r, high as low, lead(low, 1, 1000000000) over (partition by r order by low) as high from spans union all select r, 0, min(low) from spans group by r),
kept as (select r, string_agg(substr(x, 2 * low + 1, 2 * (least(high, n) - low)), '' order by low) as t from gaps join sizes using (r) group by r),
sums as (select r, count(*) as n_spans, sum(high - low) as n_removed from spans group by r)
select doc_id, n as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(t, x))) as kept_sha256
from sizes left join sums using (r) left join kept using (r)"""

ORACLE: dict[str, str] = {"op3_substring_dedup": _SUBSTRINGS, "op8_decontamination": _LEAKS, "op11_word_runs": _RUNS, "op12_hard_negatives": _NEGATIVES,
                          "op13_byte_repeats": _BYTES}
