"""Building and grading text-extraction datasets on Spark: chunking, extraction by two models, pairwise scoring, and
question-set generation."""
