"""tessera: rating prediction and text retrieval as Spark DataFrame jobs.

Every public function takes and returns DataFrames; nothing in a data path
collects to the driver.  Sub-packages:

* ``sources``   -- table loading, fixture bindings, file readers and writers
* ``functions`` -- column expressions (hash buckets, tokenizer, highlight, HTML)
* ``operators`` -- ratings, baselines, neighbourhood CF, content, factors,
                   inverted index, search, generic map/reduce
* ``plans``     -- the named queries and their DuckDB oracle SQL
"""

__version__ = "0.1.0"
