"""Token ids by words: forms of a word share one look-up, and ids are the tokenizer's for any run."""

import pyarrow as pa
import pytest

from chronodim.llm import queries, tokens

ODD = ["", None, " \t\n", "it's don't 'S x'RE", "<|endoftext|> a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>,", "</w> w> </W>x a</w>",
       "a!b a1 1a 12 3, x_y __ _", "İstanbul Iı ſharp K ŉ ǅ ɐ ɏ", "é É. Å! a̸ ≮ x≠", "ª µ º × ÷ aª. Μ ΑΣ Σ",
       "中文 ab中 Ünï中.", "\x00 a\x00 a\x1cb \x85 \xa0 a\xa0b x\xad", "a" * 3000 + "." * 3000, "🙂 a🙂 🙂!", "﻿a ​b Ǆ ﬁ Å",
       " ".join(x + m for x in ("Ab", "éT", "ß") for m in tokens.MARKS), " ".join(x + 2 * m + "!" for x in ("z", "Ñ") for m in tokens.MARKS),
       " ".join(tokens.LETTERS), tokens.LETTERS, "y" + tokens.MARKS, tokens.MARKS, "The the THE the, The! thE*** the"]


def ids_of(texts, cache):
    out = []
    for ids, at in tokens.encoded(pa.array(texts, pa.string()), cache):
        out += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
    return out


@pytest.mark.parametrize("kept, joined, block", [(250_000, 2_000, 4 << 20), (5, 3, 40), (1, 1, 1)])
def test_ids_are_the_tokenizers(monkeypatch, kept, joined, block):
    monkeypatch.setattr(tokens, "CACHE_RUNS", kept)
    monkeypatch.setattr(tokens, "JOINED_WORDS", joined)
    monkeypatch.setattr(tokens.blocks, "__defaults__", (block,))
    cache = tokens.RunCache(queries.tokenizer_path())
    want = [cache.tokenizer.encode(t or "", add_special_tokens=False).ids for t in ODD]
    assert ids_of(ODD, cache) == want
    assert ids_of(ODD[::-1] + ODD, cache) == want[::-1] + want
    assert len(cache.young) < max(kept, 2) and len(cache.old) <= kept


def test_forms_of_a_word_are_looked_up_once():
    cache = tokens.RunCache(queries.tokenizer_path())
    made = []
    new = cache._new
    cache._new = lambda runs: made.extend(runs) or new(runs)
    words = ["harbour", "été", "übung"]
    forms = [f(w) + m for w in words for f in (str, str.upper, str.title) for m in ("", ".", "***", "?!")]
    ids_of([" ".join(forms)] * 3, cache)
    ids_of([" ".join(forms)], cache)
    assert sorted(made) == sorted([*words, ".", "***", "?!", ""])          # one each; before, one for every form


def test_new_words_go_to_the_model_together(monkeypatch):
    cache = tokens.RunCache(queries.tokenizer_path())
    alone = []
    word = cache._word
    cache._word = lambda w: alone.append(w) or word(w)
    words = [a + b for a in "bcdfgh" for b in ("anda", "éo", "uzz")]
    assert ids_of([" ".join(words)], cache) == [cache.tokenizer.encode(" ".join(words), add_special_tokens=False).ids]
    assert not alone
    cache.last[:] = False                                                  # a model that does not mark every word's end
    assert cache._words(words) == [word(w) for w in words] == cache._words(words) and len(alone) == 2 * len(words)


@pytest.mark.parametrize("suffix", ["", "#", "</w>"])
def test_other_tokenizers(tmp_path, suffix):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers, trainers
    options = {"end_of_word_suffix": suffix} if suffix else {}
    made = Tokenizer(models.BPE(unk_token="?", **options))
    made.normalizer = normalizers.Lowercase()
    made.pre_tokenizer = pre_tokenizers.Whitespace()
    made.train_from_iterator(["the harbour, the sea! a# b#"] * 3, trainers.BpeTrainer(vocab_size=60, special_tokens=["?"], **options))
    made.save(str(tmp_path / "small.json"))
    cache = tokens.RunCache(str(tmp_path / "small.json"))
    texts = ["The HARBOUR, the sea!! a# #b x#y zzz", "été the", None]
    assert ids_of(texts, cache) == [cache.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert cache(["the", "the"]) == [cache._full("the")] * 2
