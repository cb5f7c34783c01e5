"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens.

A pre-token is a word boundary mark and a run of characters that are not white space. The distinct
pre-tokens of a task are inserted in one trie. The best score of a prefix is computed when its node is
made, from those of the nodes above, so words that share a prefix share its work; each pre-token
keeps its token count, and a document only adds these up. Nothing is shuffled.
"""

from __future__ import annotations

import pyarrow as pa

from scriptorium.llm.rows import result_schema, with_text

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# How far below the worst piece a character scores that no piece has; it becomes its UTF-8 bytes.
UNKNOWN_PENALTY = 10.0
# A trie that grows beyond this is begun anew; the part of a pre-token beyond MAX_DEPTH is not kept.
MAX_NODES, MAX_DEPTH = 800_000, 48


def load_vocabulary(path=VOCABULARY):
    """{piece: score} of the ordinary pieces of a vocabulary file; it is read on the driver only."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}


class PieceTrie:
    """Best segmentations of all prefixes of the pre-tokens seen so far.

    The best segmentation has the highest sum of scores and, of equal ones, the fewest tokens.
    """

    def __init__(self, pieces):
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        # Every ending of a piece, with the score of those that are pieces: past an ending that is
        # not here no longer piece can end.
        self.endings = dict.fromkeys((p[i:] for p in pieces for i in range(len(p))))
        self.endings.update(pieces)
        self.clear()

    def clear(self):
        self.children, self.score, self.tokens, self.terminal = {}, [0.0], [0], {}

    def _forward(self, text, end, path, scores, tokens):
        """Best score of text[:end] and its tokens; path[i] is where those of text[:i] stand."""
        endings = self.endings
        node = path[end - 1]
        start, score = end - 1, endings.get(text[end - 1:end])
        if score is None:
            best, least = scores[node] + self.unknown, tokens[node] + len(text[end - 1].encode("utf-8", "replace"))
        else:
            best, least = scores[node] + score, tokens[node] + 1
        while start:
            start -= 1
            score = endings.get(text[start:end], -1)
            if score is None:
                continue
            if score == -1 and text[start:end] not in endings:
                # A first character that no piece knows ends the search too: no piece holds it.
                break
            node = path[start]
            score += scores[node]
            if score > best or score == best and tokens[node] + 1 < least:
                best, least = score, tokens[node] + 1
        return best, least

    def count(self, word):
        """Number of tokens of a pre-token, given as the UTF-8 bytes of its word."""
        if len(self.score) > MAX_NODES:
            self.clear()
        text = MARK + word.decode("utf-8", "replace")
        children, scores, tokens, path, node = self.children, self.score, self.tokens, [0], 0
        for end in range(1, min(len(text), MAX_DEPTH) + 1):
            key = node << 21 | ord(text[end - 1])
            node = children.get(key)
            if node is None:
                score, n = self._forward(text, end, path, scores, tokens)
                node = children[key] = len(scores)
                scores.append(score)
                tokens.append(n)
            path.append(node)
        if len(text) <= MAX_DEPTH:
            self.terminal[word] = tokens[node]
            return tokens[node]
        scores, tokens = [scores[n] for n in path], [tokens[n] for n in path]
        places = range(len(text) + 1)
        for end in range(MAX_DEPTH + 1, len(text) + 1):
            score, n = self._forward(text, end, places, scores, tokens)
            scores.append(score)
            tokens.append(n)
        return tokens[-1]

    def count_all(self, words):
        """Number of tokens of all words together."""
        total = 0
        for word in words:
            n = self.terminal.get(word)
            total += self.count(word) if n is None else n
        return total


def pre_tokens(data):
    """The words of a text, given as UTF-8 bytes: bytes are split at ASCII white space alone."""
    return data.split()


def count_tokens(docs, pieces, keep=("doc_id",), text="text"):
    """The ``keep`` columns with n_tokens and n_pre_tokens (longs), one row per input row.

    ``pieces`` is {piece: score}, a vocabulary of fixed size. A character that no piece has counts as its
    UTF-8 bytes. A null or empty text has no tokens; repeated rows stay repeated; texts are read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    schema = result_schema(docs, keep, "n_tokens bigint, n_pre_tokens bigint")

    def run(batches):
        trie = PieceTrie(shared.value)
        for batch in batches:
            tokens, words = [], []
            for value in batch.column(len(keep)).cast(pa.binary()):
                found = pre_tokens(value.as_py() or b"")
                words.append(len(found))
                tokens.append(trie.count_all(found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(tokens, pa.int64()), pa.array(words, pa.int64())],
                [*keep, "n_tokens", "n_pre_tokens"])

    return with_text(docs, keep, text).mapInArrow(run, schema)
