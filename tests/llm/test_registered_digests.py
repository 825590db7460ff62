"""What the registered queries derive from their operators, against public libraries and brute force."""

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
import xxhash
from test_page_operators import slow_rule

from ticketloom.llm import queries

WORDS = "the Quick brown fox, jumps over lazy dogs while naïve 日本語 readers watch   and 3.14 times they wonder why".split(" ")


def texts():
    out = [None, "", " \t\n", "one", "two words", "ÀÉ ß", "x" * 5000, "a b c d", "A B C D", "\x00 ctrl   line"]
    out += [" ".join(WORDS[i % 7 :] + [str(i // 3)] * (i % 4) + WORDS) for i in range(25)]
    return out + [" ".join(WORDS * 700), out[3], out[12]]


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    documents = pd.DataFrame({"doc_id": range(100, 100 + len(texts())), "text": texts(), "piece": 1, "fingerprint": "f", "offset": 2})
    documents.to_parquet(folder / "documents.parquet", index=False)
    html = [None, "", "<p>é</p>", "<p>日</p>" * 2000, "<p>é</p>", None, "x"]
    urls = ["http://a.com/x", None, "https://WWW.example.com/en/1?q", "http://example.com/en/", "no scheme", "http://x.net/es/1", "http://net/de/"]
    pages = pd.DataFrame({"page_id": range(len(html)), "url": urls, "html": html, "record_type": "t"})
    pages.to_parquet(folder / "pages.parquet", index=False)
    return str(folder)


def test_op1_pieces(spark, sf_dir):
    got = queries.op1_best_fit_packing(spark, sf_dir).toPandas()
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path(queries.WORD_TOKENIZER))
    pieces = {(r.doc_id, r.piece): r for r in got.itertuples()}
    count = 0
    for doc_id, text in enumerate(texts(), 100):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            own, row = ids[start : start + 4096], pieces[doc_id, piece]
            packed = b"".join(i.to_bytes(4, "little") for i in own)
            assert (row.start, row.length, row.ids_crc32) == (start, len(own), zlib.crc32(packed))
            count += 1
    assert count == len(got)
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert list(rows.offset) == [0, *rows.length.cumsum()[:-1]] and rows.length.sum() <= 4096
    assert got.sequence_id.nunique() == -(-got.length.sum() // 4096)


def test_op5_rules(spark, sf_dir):
    got = queries.op5_url_filters(spark, sf_dir).toPandas().sort_values("page_id")
    urls = pd.read_parquet(f"{sf_dir}/pages.parquet").url
    for row, url in zip(got.itertuples(), urls, strict=True):
        host, path, rule, verdict = slow_rule(url)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if rule else row.verdict in ("allow", "block")


def test_op6_pages(spark, sf_dir):
    got = queries.op6_warc(spark, sf_dir).collect()
    pages = pd.read_parquet(f"{sf_dir}/pages.parquet")
    first, expected = {}, []
    for page_id, html in zip(pages.page_id, pages.html):
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        of = first.setdefault(payload, page_id)
        again = of != page_id
        expected.append((page_id, len(payload), digest, "revisit" if again else "response", of if again else None))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=lambda r: r[0]) == expected


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_op8_fingerprints(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op8_simhash_near_dedup(spark, sf_dir).collect()}
    prints = {doc_id: slow_fingerprint(text) for doc_id, text in enumerate(texts(), 100)}
    component = {doc_id: doc_id for doc_id in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4 and component[b] < component[a]:
                    component[a], changed = component[b], True
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {d: (f"{prints[d]:016x}", component[d]) for d in prints}
    sizes = defaultdict(int)
    for root in component.values():
        sizes[root] += 1
    assert max(sizes.values()) > 1


def test_op10_digests(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op10_sentencepiece(spark, sf_dir).collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_MODEL))
    sha256 = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for doc_id, text in enumerate(texts(), 100):
        ids = model.encode(text or "", add_eos=True)
        row = got.pop(doc_id)
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), sha256(" ".join(map(str, ids))), sha256(model.decode(ids)))
    assert not got
