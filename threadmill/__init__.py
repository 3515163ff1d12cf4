"""threadmill: Spark-native discussion mining.

Forum listings and comment threads in, curated post/comment tables, chunk and
vector tables, batch retrieval with reranking, prompt-ready rows, crawl-frontier
analytics and Structured Streaming versions of the incremental parts out.
Every public function maps DataFrames (plus explicit parameters) to a
DataFrame; nothing is collected to the driver except size-checked side inputs.
"""

__version__ = "0.1.0"
