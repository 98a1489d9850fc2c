"""DataFrame -> DataFrame operators: profiling, faults, cleaning, features,
sampling, preprocessing, classifiers, evaluation, learning curve."""
