"""Sources and sinks: relations, text triplets, parquet, generators."""

from .generators import (eye, fill, generate, generate_tiles, ones, sparse_zeros, spd,  # noqa: F401
                         uniform, vec_fill, vec_generate, vec_generate_tiles, vec_ones,
                         vec_uniform, vec_zeros, zeros)
from .parquet import load, load_vector, save  # noqa: F401
from .relation import (check_unique, from_arrays, from_relation, index_keys,  # noqa: F401
                       infer_extent, vector_from_relation)
from .text import read_text, read_text_vector, rejected_text, rejected_text_vector, write_text  # noqa: F401
from .store import load_stored, load_stored_vector, store  # noqa: F401
