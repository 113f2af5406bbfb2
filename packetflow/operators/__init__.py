"""DataFrame operators: protobuf decode (D1), filters (F1-F3), traffic, node info, text."""
