"""Where the public vocabulary files lie; a parameter of every operator that uses one."""

import os

try:
    from public_tokenizers import path
except ModuleNotFoundError:  # elsewhere the folder is named by a variable

    def path(name: str) -> str:
        return os.path.join(os.environ.get("TOKENIZER_FILES", "/opt/tokenizers"), name)


WORD_BPE, BYTE_BPE, PIECE_BPE = map(path, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
