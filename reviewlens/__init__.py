"""reviewlens: opinion classification of review text as Spark DataFrame jobs.

Sub-packages:
  sources    readers for raw reviews, scored-JSON reviews, lexicon files and the
             test-data tables
  functions  column expressions (HTML stripping, tokenizers, normalisers)
  operators  the DataFrame operators: lexicon scoring, naive Bayes, class-mean
             vectors, TF-IDF neighbours, hold-out evaluation
  sinks      prediction / report writers
  plans      end-to-end jobs and the registered query catalogue
  streaming  micro-batch scoring of arriving reviews
"""

from reviewlens.session import get_session, checkpoint_dir  # noqa: F401
