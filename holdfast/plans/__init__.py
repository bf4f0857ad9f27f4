"""The jobs: content lists, campaigns, messages, outbox, training, scoring."""
