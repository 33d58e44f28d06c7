"""The cleaning path on a stream of landed raw documents."""
