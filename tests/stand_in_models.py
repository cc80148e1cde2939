"""Models for tests of the command line."""


def scorer():
    return lambda src, mt: [len(s) / 100 for s in src]


def generator():
    return lambda prompts: [p.upper() for p in prompts]
