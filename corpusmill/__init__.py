"""corpusmill: a PySpark engine that prepares text corpora for training and retrieval."""
